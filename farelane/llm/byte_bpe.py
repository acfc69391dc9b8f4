"""Ids of the byte-level BPE vocabulary, batch by batch.

Texts are cut into words by array operations that follow the vocabulary's pattern; each distinct
word is encoded once and its ids are copied. Texts with the vocabulary's special string go through
the tokenizers library itself. Ids equal those of that library (tests compare them).
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np

from .text import SPACE, chunks, classes, code_points, gather, span_hashes

#: Distinct words kept by a Python worker; beyond it the store starts anew.
WORDS = 1_000_000
SPECIAL = "<|endoftext|>"
#: Longer words are encoded where they stand.
LONG = 256


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def word_starts(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the code points at which a word of the pattern starts. first: offsets at which texts start.

    The pattern: 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|white space not before text|white space
    """
    kind = classes()[cps]
    n = len(cps)
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    begins[n] = True
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~begins[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True
    start[last[cps[last] == 32] + 1] = False
    quotes = np.flatnonzero(cps == 39)
    while len(quotes):  # a contraction can be followed by another one only; then once more
        quotes = quotes[start[quotes]]
        ahead = np.zeros((2, len(quotes)), np.uint32)
        for k in (1, 2):
            inside = quotes + k < n
            inside[inside] &= ~np.logical_or.reduce([begins[quotes[inside] + j] for j in range(1, k + 1)])
            ahead[k - 1, inside] = cps[quotes[inside] + k]
        one = np.isin(ahead[0], [115, 116, 109, 100])
        two = (ahead[0] == 114) & (ahead[1] == 101) | (ahead[0] == 118) & (ahead[1] == 101) | (ahead[0] == 108) & (ahead[1] == 108)
        start[quotes[one | two] + 1] = False
        start[quotes[two] + 2] = False
        after = np.concatenate([quotes[one] + 2, quotes[two & ~one] + 3])
        after = after[after < n]
        fresh = after[~start[after]]
        start[after] = True
        quotes = np.sort(fresh[cps[fresh] == 39])
    return start


class Encoder:
    """Ids of whole texts."""

    def __init__(self, path: str):
        import tiktoken

        ranks_file = Path(path).with_suffix(".tiktoken")
        self.path = path
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.read_bytes().splitlines() if line)}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.where = np.zeros((2, 0), np.int64)
        self.pool = np.zeros(0, np.uint32)

    @lru_cache(1)  # noqa: B019  one encoder lives as long as its worker
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = [self.bpe._core_bpe.encode_single_piece(w.encode("utf-8", "replace")) for w in words]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        start = np.cumsum(length) - length + len(self.pool)
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum()))])
        order = np.argsort(known := np.concatenate([self.known, hashes]), kind="stable")
        self.known, self.where = known[order], np.concatenate([self.where, np.stack([start, length])], axis=1)[:, order]

    def chunk(self, pieces: list[str]) -> list[np.ndarray]:
        text = "".join(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        if not text:
            return [np.zeros(0, np.uint32)] * len(pieces)
        cps = code_points(text)
        start = np.flatnonzero(word_starts(cps, offsets[:-1][sizes > 0]))
        end = np.append(start[1:], len(cps))
        h = span_hashes(cps, start, end)
        for i in np.flatnonzero(end - start > LONG):  # by content, not by a polynomial
            h[i] = np.uint64(hash(text[start[i] : end[i]]) & (1 << 64) - 1)
        uniq, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > WORDS:
            self.forget()
        spot = np.searchsorted(self.known, uniq)
        new = np.flatnonzero(np.append(self.known, 0)[np.minimum(spot, len(self.known))] != uniq) if len(self.known) else np.arange(len(uniq))
        if len(new):
            self.learn(uniq[new], [text[a:b] for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
            spot = np.searchsorted(self.known, uniq)
        begin, length = self.where[:, spot[back]]
        ids = self.pool[gather(begin, length)]
        total = np.concatenate([[0], np.cumsum(length)])
        edges = total[np.searchsorted(start, offsets)]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        plain = [t if SPECIAL not in t else "" for t in texts]
        for who, what in chunks(plain):
            for i, ids in zip(who, self.chunk(what), strict=True):
                parts[i].append(ids)
        out = [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]
        for i, t in enumerate(texts):
            if SPECIAL in t:
                out[i] = np.array(self.library().encode(t, add_special_tokens=False).ids, np.uint32)
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
