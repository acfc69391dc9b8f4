"""SentencePiece encoding and decoding by a streaming Viterbi search (operator 6).

The pieces of a model file form a lattice over a text (a space is written as U+2581, one is put before the text). ``Stream`` is fed
text bit by bit and finds for each position the best path that ends there:

* unigram models: the path with the largest sum of scores, ties going to the longer last piece. A character that no piece covers costs
  more than any piece.
* BPE models: a path counts only if merging would give each two neighbouring pieces of it (a step's score is 0 or minus
  infinity). Merges are local, so a path of such steps is what merging the whole text gives, and each position has exactly one. These are the ids
  that the model's own merges give, without holding the text.

A character that no piece covers is written by its byte pieces. A step needs only the last ``longest piece`` positions. Back pointers are kept
until the paths of all these positions go through one boundary: then the ids up to it are committed, and the window starts there. This is
looked for whenever the window has doubled, so the time is linear in the text; where paths don't converge for long (a run of one character under a
unigram model), what is held are six bytes a character of back pointers in a flat array, and the ids stay exact.

No path can skip a boundary that no piece spans: before a space mark that follows another character, and around characters that occur in no
longer piece. All paths converge there, and what follows doesn't depend on what came before. So each distinct stretch between such
boundaries goes through a ``Stream`` once and its ids are copied where it occurs again; this gives the ids that one stream over the whole text gives.

Edges: null text is empty text, which has no ids. Repeated rows are separate rows; an empty table gives no rows. Other columns are
ignored. Decoding the ids gives the text back exactly (U+2581 in a text comes back as the space it stands for).
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table
from .text import chunks, code_points, gather, span_hashes

SPACE = "▁"
#: Characters that a stream takes between two looks for a boundary, at least.
STEP = 64
#: Stretches longer than this are known by another hash, which long runs of one character don't weaken.
LONG = 64
#: Stretches, and pairs of pieces, that an encoder remembers before it starts anew.
WORDS, PAIRS = 1_000_000, 4_000_000
#: Stands for the token before a text's first one; more than there are ids and code points.
START = 1 << 22


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


class Model:
    """Pieces of a model file; ``merges``: they are joined by rank (BPE) and not weighed by score (unigram); None: as the file says."""

    def __init__(self, path: str, merges: bool | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if merges is None:
            merges = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto()).trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        n = sp.get_piece_size()
        score: dict[str, tuple[float, int]] = {}
        bytes_of, byte_id = [b""] * n, [sp.unk_id()] * 256
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                byte_id[value], bytes_of[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                score[piece], bytes_of[i] = (sp.get_score(i), i), piece.replace(SPACE, " ").encode()
        self.build(score, bytes_of, byte_id, merges)

    @classmethod
    def of(cls, score: dict[str, tuple[float, int]], merges: bool) -> Model:
        """From pieces with score and id."""
        model = cls.__new__(cls)
        bytes_of = [b""] * (1 + max(i for _, i in score.values()))
        for piece, (_, i) in score.items():
            bytes_of[i] = piece.replace(SPACE, " ").encode()
        model.build(score, bytes_of, [0] * 256, merges)
        return model

    def build(self, score: dict[str, tuple[float, int]], bytes_of: list[bytes], byte_id: list[int], merges: bool) -> None:
        self.score, self.bytes_of, self.byte_id, self.merges = score, bytes_of, byte_id, merges
        self.longest = max(map(len, score))
        self.unknown = min(s for s, _ in score.values()) - 10.0
        self.text_of = {i: p for p, (_, i) in score.items()}
        self.ending: dict = {}  # pieces from their last character backwards: [(score, id) or None, what may stand before]
        for piece, held in score.items():
            node, at = [None, self.ending], self.ending
            for c in reversed(piece):
                node = at.setdefault(c, [None, {}])
                at = node[1]
            node[0] = held
        self.pairs: dict[int, bool] = {}
        joined = [p for p in score if len(p) > 1]
        self.spans_space = any(p[k] == SPACE and p[k - 1] != SPACE for p in joined for k in range(1, len(p)))
        self.solo = np.ones(0x110000, bool)
        self.solo[[ord(c) for c in set("".join(joined))]] = False

    def joined(self, text: str) -> list[str]:
        """What merging gives for a short text: the best pair first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            found = [(-self.score[p][0], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.score]
            if not found:
                return parts
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def named(self, token: int) -> str:
        """The text of a token: a piece's id, or -1 - code point for a character that no piece covers."""
        return chr(-1 - token) if token < 0 else self.text_of[token]

    def fits(self, a: int, b: int) -> bool:
        """Merging the text of tokens a and b (a START: of b alone) gives these tokens."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        want = [self.named(b)] if a == START else [self.named(a), self.named(b)]
        known = self.pairs[a * START + b] = self.joined("".join(want)) == want
        return known

    def ids(self, tokens: list[int]) -> list[int]:
        if not tokens or min(tokens) >= 0:
            return tokens
        return list(chain.from_iterable([t] if t >= 0 else [self.byte_id[b] for b in chr(-1 - t).encode("utf-8", "replace")] for t in tokens))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space put before it is taken off."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


class Stream:
    """Ids of a (marked) text that arrives in parts."""

    def __init__(self, model: Model):
        self.model = model
        self.tail = ""  # of the text, as far as a piece can reach back; top: the scores of its positions (first the one before it)
        self.top = [0.0]
        self.size, self.token = array("H"), array("i")  # last step of the path to each position since the last commit
        self.last = START  # token before them
        self.next = STEP
        self.most = 0  # positions held at once

    def feed(self, part: str) -> list[int]:
        """Takes more text; returns the ids committed by it."""
        out: list[int] = []
        longest = self.model.longest
        for a in range(0, len(part), STEP):
            text = self.tail + part[a : a + STEP]
            (self.by_merges if self.model.merges else self.by_scores)(text, len(self.tail))
            self.tail = text[-longest:]
            self.top = self.top[-1 - len(self.tail) :]
            self.most = max(self.most, len(self.size))
            if len(self.size) >= self.next:
                out += self.commit()
                self.next = max(STEP, 2 * len(self.size))
        return out

    def by_scores(self, text: str, known: int) -> None:
        """Best steps to the positions of text after the first ``known``."""
        m, top = self.model, self.top
        for j in range(known + 1, len(text) + 1):
            before, i, held, size, token = m.ending, j, -1e300, 1, -1 - ord(text[j - 1])
            while i and (node := before.get(text[i - 1])) is not None:
                i -= 1
                p, before = node
                if p is not None and top[i] + p[0] >= held:
                    held, size, token = top[i] + p[0], j - i, p[1]
            if text[j - 1] not in m.score and top[j - 1] + m.unknown > held:
                held, size, token = top[j - 1] + m.unknown, 1, -1 - ord(text[j - 1])
            top.append(held)
            self.size.append(size)
            self.token.append(token)
        least = min(top)
        if least < -1e9:  # only differences count
            self.top = [t - least for t in top]

    def by_merges(self, text: str, known: int) -> None:
        """The only possible steps to the positions of text after the first ``known``."""
        m, size, token = self.model, self.size, self.token
        pairs, gone = m.pairs, len(self.size) - known  # position i of text is the end of step gone + i - 1
        for j in range(known + 1, len(text) + 1):
            before, i, ways = m.ending, j, []
            while i and (node := before.get(text[i - 1])) is not None:
                i -= 1
                p, before = node
                if p is not None:
                    ways.append((i, p[1]))
            if not ways or ways[0][0] != j - 1:
                ways.insert(0, (j - 1, -1 - ord(text[j - 1])))
            while True:  # the longest first; one of them fits
                i, t = ways.pop()
                at = gone + i - 1
                a = token[at] if at >= 0 else self.last
                fine = pairs.get(a * START + t)
                if m.fits(a, t) if fine is None else fine:
                    break
            size.append(j - i)
            token.append(t)

    def commit(self) -> list[int]:
        """Ids up to the last boundary that the paths of all positions still in reach go through."""
        j, size = len(self.size), self.size
        ends = set(range(max(0, j - self.model.longest + 1), j + 1))
        while len(ends) > 1:
            last = max(ends)
            ends.discard(last)
            ends.add(last - size[last - 1])
        return self.taken(ends.pop())

    def taken(self, at: int) -> list[int]:
        tokens, j = [], at
        while j:
            tokens.append(self.token[j - 1])
            j -= self.size[j - 1]
        if tokens:
            self.last = tokens[0]
        del self.size[:at], self.token[:at]
        return self.model.ids(tokens[::-1])

    def close(self) -> list[int]:
        return self.taken(len(self.size))


class Encoder:
    """Ids of whole texts, batch by batch; each distinct stretch between sure boundaries is searched once."""

    def __init__(self, path: str, merges: bool | None = None):
        self.model = Model(path, merges)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.where = np.zeros((2, 0), np.int64)
        self.pool = np.zeros(0, np.uint32)

    def search(self, word: str) -> list[int]:
        stream = Stream(self.model)
        return [*stream.feed(word), *stream.close()]

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = [self.search(w) for w in words]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        start = np.cumsum(length) - length + len(self.pool)
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum()))])
        order = np.argsort(known := np.concatenate([self.known, hashes]), kind="stable")
        self.known, self.where = known[order], np.concatenate([self.where, np.stack([start, length])], axis=1)[:, order]

    def chunk(self, pieces: list[str]) -> list[np.ndarray]:
        text = "".join(pieces)
        offsets = np.cumsum([0, *map(len, pieces)])
        if not text:
            return [np.zeros(0, np.uint32)] * len(pieces)
        cps = code_points(text)
        mark, solo = cps == ord(SPACE), self.model.solo[cps]
        start = solo.copy()
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        start[1:] |= solo[:-1]
        if not self.model.spans_space:
            start[1:] |= mark[1:] & ~mark[:-1]
        start = np.flatnonzero(start)
        end = np.append(start[1:], len(cps))
        h = span_hashes(cps, start, end)
        for i in np.flatnonzero(end - start > LONG):
            h[i] = np.uint64(hash(text[start[i] : end[i]]) & (1 << 64) - 1)
        uniq, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > WORDS:
            self.forget()
        new = np.flatnonzero(~np.isin(uniq, self.known, assume_unique=True))
        if len(new):
            self.learn(uniq[new], [text[a:b] for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
        begin, length = self.where[:, np.searchsorted(self.known, uniq)[back]]
        ids = self.pool[gather(begin, length)]
        total = np.concatenate([[0], np.cumsum(length)])
        edges = total[np.searchsorted(start, offsets)]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        marked = [(" " + t).replace(" ", SPACE) if t else "" for t in texts]
        spaced = lambda piece: piece.replace(" ", SPACE)
        for who, what in chunks([t.replace(SPACE, " ") for t in marked]):
            for i, ids in zip(who, self.chunk([spaced(w) for w in what]), strict=True):
                parts[i].append(ids)
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the ids of every text."""
    path = path or default_path()
    prepare(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            ids = encode([t or "" for t in batch.column(1).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "doc_id long, ids array<int>")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256 (of the text decoded from the ids), exact (it is the text)."""
    path = path or default_path()
    prepare(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = e.encode(texts)
            back = [e.model.decode(x) for x in ids]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in back], pa.string()),
                    pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "exact"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, exact boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
