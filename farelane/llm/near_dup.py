"""Near-duplicate documents: DartMinHash signatures, banded joining, exact verification (operator 2).

A document is a weighted set of hashed five-word shingles (words: runs of letters and digits, case folded; a document of fewer
words is one shingle of all of them); a shingle that occurs n times weighs 1 + floor(log2(n)), so a text without repeats is a plain set, and
one line repeated through two texts doesn't make them copies (as plain counts would). Two documents are near if their weighted Jaccard similarity (sum
of the smaller weights over sum of the larger) is ``LEAST`` or more. Documents with equal weighted sets are one node from the
start. Signatures of ``K`` darts are cut into ``BANDS`` bands of ``ROWS``; nodes that share a band's value are in a bucket. A pair
of similarity 0.8 shares a bucket with probability 0.998; all pairs that share one are decided by the exact similarity of their (64-bit hashed) sets:

1. In each bucket the node with the smallest number is the pivot; every other is paired with it, so the pairs grow with the
   bucket, not with its square. Pairs are verified.
2. Verified pairs give components. A bucket whose nodes lie in one component is settled.
3. In every other bucket the nodes outside its most common component are compared with all nodes of other components, in cells of about
   ``2 * CELL`` nodes whatever the bucket's size. A cell counts all its common shingles in one sparse product, and gives
   the links that join components.

The class of a document is the smallest doc_id of its component.

Edges: null text is empty text. Documents without a word are alike only if their text is the same up to white space. Rows repeating a
doc_id are rows of their own; null ids sort last. An empty table gives no rows. Other columns are ignored by ``classes_of`` and
passed through by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, keep_rows, prepare, table, text_mark
from .dart_minhash import signatures, unit_cells
from .text import LETTER, NUMBER, chunks, classes, code_points, mixed, span_hashes

WORDS, LEAST = 5, 0.8
#: 21 bands of 6: a pair of similarity 0.8 shares a band with probability 0.998.
BANDS, ROWS = 21, 6
K = BANDS * ROWS
#: Nodes of either side of a cell, and shingles at most (about); rows of one open bucket that a task joins.
CELL, CELL_SHINGLES, SPLIT = 128, 1 << 20, 1024
#: Shingles of a cell counted at a time.
COLUMNS = 4096
#: Candidate ids are broadcast up to this many (8 bytes each), else joined.
BROADCAST_ROWS = 1_000_000


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text, in order."""
    kinds = classes()
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for who, what in chunks([t.lower() for t in texts]):
        cps = code_points(" ".join(what) + " ")
        kind = kinds[cps]
        edge = np.diff(((kind == LETTER) | (kind == NUMBER)).astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        h = span_hashes(cps, start, end)
        offsets = np.cumsum([0, *(len(w) + 1 for w in what)])
        cuts = np.searchsorted(start, offsets)
        for i, a, b in zip(who, cuts[:-1], cuts[1:], strict=True):
            parts[i].append(h[a:b])
    return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]


def shingles(words: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles, sorted, and their weights."""
    if not len(words):
        return words, np.zeros(0)
    size = min(size, len(words))
    h = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        h = h * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - size + 1 + k]
    found, counts = np.unique(mixed(h), return_counts=True)
    return found, np.floor(np.log2(counts)) + 1


def weighted(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A weighted set as a plain one, sorted: an element of weight 3 is three; Jaccard similarity stays the same."""
    return np.sort(unit_cells(found, weights)[0]) if len(found) else found


def band_values(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A row of band values for each signature."""
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for k in range(rows):
        h = mixed(h * np.uint64(0xD1342543DE82EF95) + sig[:, k::rows])
    return h.view(np.int64)


def set_key(s: np.ndarray, text: str) -> bytes:
    """128-bit digest of a shingle set, or of a text without words."""
    return hashlib.blake2b(s.tobytes() if len(s) else b"text " + " ".join(text.split()).encode("utf-8", "replace"), digest_size=16).digest()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, mark, key, size, bands."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            sets = [shingles(w) for w in word_hashes(texts)]
            some = [x for x in sets if len(x[0])]
            bands = band_values(signatures([x for x, _ in some], K, [w for _, w in some]))
            ends = np.cumsum([0, *(BANDS * (len(x) > 0) for x, _ in sets)]).astype(np.int32)
            keys = pa.array([set_key(weighted(*x), t) for x, t in zip(sets, texts, strict=True)], pa.binary())
            size = pa.array([int(w.sum()) for _, w in sets], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), keys, size, pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel()))], ["doc_id", "mark", "key", "size", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark().alias("mark"), "text").mapInArrow(of, "doc_id long, mark long, key binary, size long, bands array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """key, shingles (the weighted set as a sorted plain one of 64-bit hashes) of documents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a in range(0, len(texts), 256):
                some = texts[a : a + 256]
                sets = [weighted(*shingles(w)) for w in word_hashes(some)]
                held = [(set_key(s, t), s.tobytes()) for s, t in zip(sets, some, strict=True) if len(s)]
                yield pa.record_batch([pa.array([x[k] for x in held], pa.binary()) for k in (0, 1)], ["key", "shingles"])

    return docs.select("text").mapInArrow(of, "key binary, shingles binary")


def views(column: pa.Array) -> list[np.ndarray]:
    """The sets of a binary column, in place."""
    if not len(column):
        return []
    _, ends, held = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    held = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
    return [held[a:b].view(np.uint64) for a, b in itertools.pairwise(ends)]


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Exact Jaccard similarity of two sorted sets of distinct values is at least ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= least * (len(both) - common) - 1e-9


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fine = [alike(x, y, least) for x, y in zip(views(b.column(2)), views(b.column(3)), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(of, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each component of (a, b); neighbours' minima with pointer jumping until nothing changes."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    held = labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")).checkpoint()
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        moved = lower.join(jump, "to").select("node", F.least("to", "beyond").alias("new"), "label").checkpoint()
        discard(held)
        held, labels = moved, moved.select("node", F.col("new").alias("label"))
        if moved.filter("new <> label").isEmpty():
            discard(both)
            return labels


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each pair of sets, from the product of their 0/1 matrices over the elements that both sides have."""
    out = np.zeros((len(left), len(right)))
    sides = []
    for sets in (left, right):
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
        sides.append((flat, np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    both = np.intersect1d(*(np.unique(flat) for flat, _ in sides), assume_unique=True)
    places = []
    for flat, row in sides:
        at = np.searchsorted(both, flat)
        fine = at < len(both)
        fine[fine] = both[at[fine]] == flat[fine]
        at, row = at[fine], row[fine]
        order = np.argsort(at, kind="stable")
        places.append((at[order], row[order]))
    for a in range(0, len(both), COLUMNS):
        parts = []
        for (at, row), sets in zip(places, (left, right), strict=True):
            p, q = np.searchsorted(at, [a, a + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, len(both) - a)), np.float32)
            part[row[p:q], at[p:q] - a] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T  # at most COLUMNS ones: exact
    return out


def links_across(t: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links of a cell that join components: between its rare nodes (asks) and nodes of other components whose sets are similar enough."""
    node, label, rare, asks = (t.column(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "rare", "asks"))
    sets = [x for part in t.column("shingles").chunks for x in views(part)]
    size = np.array([len(s) for s in sets])
    left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
    common = common_counts([sets[i] for i in left], [sets[j] for j in right])
    fine = common >= least * (size[left][:, None] + size[right][None, :] - common) - 1e-9
    fine &= label[left][:, None] != label[right][None, :]
    fine &= ~rare[right][None, :] | (node[right][None, :] > node[left][:, None])  # two rare nodes ask once
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(fine)), strict=True):
        i, j = left[i], right[j]
        p, q = root(int(label[i])), root(int(label[j]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((int(node[i]), int(node[j])))
    return out


def cells(labelled: DataFrame) -> DataFrame:
    """h, i, j, node, label, rare, asks: the cells of the buckets whose nodes are in several components.

    A bucket's rare nodes are those outside its most common component; of two nodes in different components at least one is rare. Chunk i
    of the rare nodes (asks) meets chunk j of all nodes in cell (i, j): about CELL of either, and where few nodes are rare
    a bucket is dealt out about once. A large bucket meets its numbers in parts of about SPLIT rows.
    """
    parts = labelled.groupBy("h", "label").agg(F.count("*").alias("n"), F.sum("size").alias("m"), F.first("all_n").alias("all_n"))
    whole = parts.groupBy("h").agg(F.max(F.struct("n", "label", "m")).alias("usual"), F.sum("n").alias("n"), F.sum("m").alias("m"), F.count("*").alias("parts"), F.first("all_n").alias("all_n"))
    chunks = lambda n, m: F.ceil(F.greatest(n / CELL, m / CELL_SHINGLES))
    few = chunks(F.col("n") - F.col("usual.n"), F.col("m") - F.col("usual.m"))
    split = F.ceil(F.col("all_n") / SPLIT)
    whole = whole.filter("parts > 1").select("h", F.col("usual.label").alias("usual"), chunks(F.col("n"), F.col("m")).alias("all"), few.alias("few"), split.alias("split"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    own = lambda n: F.pmod(F.xxhash64("node", "h"), n)
    rows = labelled.withColumn("part", F.pmod(F.xxhash64("node"), split)).join(whole.withColumn("part", each(F.col("split"))), ["h", "part"])
    rows = rows.withColumn("rare", F.col("label") != F.col("usual"))
    told = rows.select("h", own(F.col("all")).alias("j"), "node", "label", "rare", F.lit(False).alias("asks"), each(F.col("few")).alias("i"))
    ask = rows.filter("rare").select("h", own(F.col("few")).alias("i"), "node", "label", "rare", F.lit(True).alias("asks"), each(F.col("all")).alias("j"))
    return told.unionByName(ask)


def classes_of(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """A row for each document: doc_id, class_id, class_size, kept, mark."""
    prepare(docs.sparkSession)
    rows = sketches(docs).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    nodes = rows.groupBy("key").agg(F.min("row").alias("node"), F.first("size").alias("size"), F.first("bands").alias("bands")).checkpoint()
    members = nodes.select("node", "size", F.explode("bands").alias("h"))
    shared = members.groupBy("h").agg(F.min("node").alias("pivot"), F.count("*").alias("all_n")).filter("all_n > 1")
    buckets = members.join(shared, "h").checkpoint()
    pairs = buckets.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct().checkpoint()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    wanted = rows.join(wanted, "row").select(F.col("doc_id").alias("want"), "key", F.col("row").alias("node")).checkpoint()
    ids = wanted.select("want").distinct()
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_ROWS else ids
    some = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    some = some.join(ids, some["id"].eqNullSafe(ids["want"]), "left_semi")
    sets = full_sets(some).dropDuplicates(["key"]).join(wanted.select("key", "node"), "key").drop("key").checkpoint()
    edges = verified(pairs, sets, least).checkpoint()
    labels = components(edges)

    def across(t: pa.Table) -> pa.Table:
        found = links_across(t, least)
        return pa.table({"a": pa.array([p for p, _ in found], pa.int64()), "b": pa.array([q for _, q in found], pa.int64())})

    labelled = buckets.select("h", "node", "size", "all_n").join(labels, "node", "left").select("h", "node", "size", "all_n", F.coalesce("label", "node").alias("label"))
    left = cells(labelled)
    more = left.join(sets, "node").groupBy("h", "i", "j").applyInArrow(across, "a long, b long").distinct().checkpoint()
    if not more.isEmpty():
        labels = components(edges.unionByName(more))
    named = rows.join(nodes.select("key", "node"), "key").join(labels, "node", "left").select("doc_id", "mark", "row", F.coalesce("label", "node").alias("label"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    heads = named.groupBy("label").agg(F.min(first).alias("first"), F.count("*").alias("n")).checkpoint()  # else the join below would share its exchange, and a large class stay in one task
    for used in (buckets, pairs, wanted, sets, edges, more):
        discard(used)
    return named.join(heads, "label").select("doc_id", F.col("first.doc_id").alias("class_id"), F.col("n").alias("class_size"), (F.col("row") == F.col("first.row")).alias("kept"), "mark")


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One document of each class, with all columns."""
    return keep_rows(docs, classes_of(docs, least))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_of(table(spark, sf_dir, "documents")).drop("mark")


#: All pairs that share a shingle, compared exactly, and their components.
SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS no, doc_id, coalesce(text, '') AS t, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), grams AS (
  SELECT no, unnest(CASE WHEN len(w) = 0 THEN ['text ' || trim(regexp_replace(t, '\s+', ' ', 'g'))]
                         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g, len(w) > 0 AS worded FROM docs
), weights AS (
  SELECT no, hash(g, worded) AS g, 1 + floor(log2(count(*))) AS x FROM grams GROUP BY 1, 2
), sizes AS (
  SELECT no, sum(x) AS n FROM weights GROUP BY 1
), common AS (
  SELECT a.no AS a, b.no AS b, sum(least(a.x, b.x)) AS c FROM weights a JOIN weights b ON a.g = b.g AND a.no < b.no GROUP BY 1, 2
), edges AS (
  SELECT a, b FROM common JOIN sizes x ON x.no = a JOIN sizes y ON y.no = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), links AS (
  SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges
), reach AS (
  SELECT no AS a, no AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), label AS (
  SELECT a AS no, min(b) AS first FROM reach GROUP BY 1
)
SELECT d.doc_id, h.doc_id AS class_id, count(*) OVER (PARTITION BY first) AS class_size, d.no = first AS kept
FROM docs d JOIN label USING (no) JOIN docs h ON h.no = first
"""
