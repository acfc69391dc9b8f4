"""Language identification by nearest centroid (operator 1).

A text is a vector of hashed character n-grams (one to three letters, within words, case folded),
weighted by ``log(1 + count) * idf`` and normalised. Each language has several centroids, found by
spherical k-means; the language of the centroid with the largest cosine is predicted, and the
cosine is the score. A text is rejected if it has no letter or if its cosine is below the floor of that language
for texts of its length: ``REJECT`` times the ``QUANTILE`` of the cosines that the ``NEAR`` labelled texts of the sample nearest in length
had with centroids of their own language fitted without them. Short texts have low cosines, so a floor for all lengths
would either keep long gibberish or reject clean words; gibberish of a word or two can't be told from them and stays.

Learning uses text and lang of rows with crc32(doc_id) mod 5 <> 0 and a lang: document frequencies over
all of them, centroids on about ``SAMPLE`` of them, dealt evenly over the languages and chosen by a
hash (the documented bound of the classifier's fit). lang, source and doc_id are no inputs of a prediction.

Edges: null text and text without a letter are ``und`` with score 0. A null doc_id counts as held out.
Without any labelled row every text is ``und``. Repeated rows are separate rows. Other columns are
ignored by ``predict`` and passed through by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table
from .text import LETTER, chunks, classes, code_points

BITS = 12
SIZE = 1 << BITS
#: Labelled texts on which centroids are fitted, over all languages.
SAMPLE = 2048
#: Centroids of a language.
CENTROIDS = 4
#: Labels learned at most, the most frequent ones.
LANGUAGES = 200
#: Share of the low quantile of the sample's cosines below which a text is rejected.
REJECT = 0.6
QUANTILE = 0.01
#: Sample texts of like length that a floor rests on.
NEAR = 64
#: Parts of the sample whose cosines come from centroids of the others.
FOLDS = 5
#: Classes of length: powers of two of the number of n-grams.
LENGTHS = 32
UNKNOWN = "und"
#: Texts counted at a time.
ROWS = 256


def ngram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams, a row for each text; whole texts."""
    out = np.zeros((len(texts), SIZE), np.int32)
    kinds = classes()
    for who, what in chunks([t.lower() for t in texts]):
        cps = code_points(" " + " ".join(what) + " ").astype(np.uint64)
        cps[kinds[cps] != LETTER] = 0
        at = np.flatnonzero(cps)
        row = np.repeat(np.array(who, np.int64), [len(w) + 1 for w in what])[at - 1]
        before, here, after = cps[at - 1], cps[at], cps[at + 1]
        for k, gram in enumerate((here, here << np.uint64(21) | after, before << np.uint64(42) | here << np.uint64(21) | after)):
            h = (gram * np.uint64(4) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)
            low = int(row[0]) if len(row) else 0
            n = (int(row[-1]) - low + 1) * SIZE if len(row) else 0
            out[low : low + n // SIZE] += np.bincount((row - low) * SIZE + h.astype(np.int64), minlength=n).reshape(-1, SIZE).astype(np.int32)
    return out


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of the centroids
    centroids: np.ndarray  # a column for each
    least: np.ndarray  # cosine of rejection, for each centroid and class of length

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        for a in range(0, len(texts), ROWS) if self.languages else ():
            counts = ngram_counts(texts[a : a + ROWS])
            cosines = self.vectors(counts) @ self.centroids
            best, size = cosines.argmax(axis=1), length_class(counts)
            for i in np.flatnonzero(counts.any(axis=1)).tolist():
                k = int(best[i])
                lang[a + i], score[a + i] = self.languages[k], float(np.clip(cosines[i, k], 0, 1))
                rejected[a + i] = cosines[i, k] < self.least[k, size[i]]
        return lang, score, rejected


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; the first is the mean's direction, each next one starts at the farthest vector."""
    unit = lambda v: v / max(float(np.linalg.norm(v)), 1e-12)
    centres = [unit(x.mean(axis=0))]
    while len(centres) < min(k, len(x)):
        centres.append(x[int((x @ np.array(centres).T).max(axis=1).argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        to = (x @ c.T).argmax(axis=1)
        c = np.array([unit(x[to == j].mean(axis=0)) if (to == j).any() else c[j] for j in range(len(c))])
    return c


def length_class(counts: np.ndarray) -> np.ndarray:
    """Of each row: floor(log2) of its number of n-grams."""
    return np.log2(np.maximum(counts.sum(axis=1, dtype=np.int64), 1)).astype(int).clip(0, LENGTHS - 1)


def floors(x: np.ndarray, counts: np.ndarray, centroids: int) -> np.ndarray:
    """Cosine of rejection for each class of length, from cosines of vectors that the centroids weren't fitted on."""
    fold = np.arange(len(x)) % FOLDS
    cosine = np.zeros(len(x))
    for k in range(FOLDS) if len(x) > 1 else ():
        if (fold == k).any():
            cosine[fold == k] = (x[fold == k] @ spherical_kmeans(x[fold != k], centroids).T).max(axis=1)
    size = np.log2(np.maximum(counts.sum(axis=1, dtype=np.int64), 1))
    near = [np.argsort(np.abs(size - (j + 0.5)), kind="stable")[:NEAR] for j in range(LENGTHS)]
    return np.array([REJECT * np.quantile(cosine[i], QUANTILE, method="lower") for i in near])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS, languages: int = LANGUAGES) -> Model:
    """From a sample by hash, equal rows once; of the labels only the most frequent ``languages`` are learned."""
    spark = prepare(docs.sparkSession)
    rows = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not by_lang:
        return Model(np.ones(SIZE, np.float32), [], np.zeros((SIZE, 0), np.float32), np.zeros((0, LENGTHS)))
    each = -(-sample // len(by_lang))
    share = F.create_map(*[F.lit(x) for k, n in sorted(by_lang.items()) for x in (k, min(1.0, each / n))])
    mark = F.xxhash64("doc_id", "text")
    chosen = F.coalesce((F.pmod(mark, F.lit(1_000_003)) / 1_000_003) < F.try_element_at(share, F.col("lang")), F.lit(False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts_seen, name = np.zeros(SIZE, np.int64), 0, ["lang", "mark", "feature", "n"]
        for batch in batches:
            texts, langs, take, marks = (batch.column(k).to_pylist() for k in range(4))
            for a in range(0, len(texts), ROWS):
                c = ngram_counts(texts[a : a + ROWS])
                seen += (c > 0).sum(axis=0)
                texts_seen += len(c)
                for i in [i for i in range(len(c)) if take[a + i]]:
                    f = np.flatnonzero(c[i])
                    if len(f):
                        yield pa.record_batch([pa.array([langs[a + i]]), pa.array([marks[a + i]]), pa.array([f.tolist()], pa.list_(pa.int32())), pa.array([c[i, f].tolist()], pa.list_(pa.int64()))], name)
        f = np.flatnonzero(seen)
        yield pa.record_batch([pa.array([None], pa.string()), pa.array([None], pa.int64()), pa.array([[*f.tolist(), SIZE]], pa.list_(pa.int32())), pa.array([[*seen[f].tolist(), texts_seen]], pa.list_(pa.int64()))], name)

    counted = rows.select("text", "lang", chosen.alias("take"), mark.alias("mark")).mapInArrow(count, "lang string, mark long, feature array<int>, n array<long>").checkpoint()
    totals = counted.filter("lang IS NULL").select(F.explode(F.arrays_zip("feature", "n")).alias("x")).groupBy("x.feature").agg(F.sum("x.n").alias("n"))
    seen = np.zeros(SIZE + 1)
    for r in totals.collect():  # at most SIZE + 1 rows
        seen[r["feature"]] = r["n"]
    model = Model(np.log((1 + seen[SIZE]) / (1 + seen[:SIZE])).astype(np.float32) + 1, [], np.zeros((SIZE, 0), np.float32), np.zeros((0, LENGTHS)))
    by: dict[str, list[np.ndarray]] = {}
    for r in counted.filter("lang IS NOT NULL").dropDuplicates(["lang", "mark"]).toLocalIterator():  # about `sample` rows
        x = np.zeros(SIZE, np.int32)
        x[r["feature"]] = r["n"]
        by.setdefault(r["lang"], []).append(x)
    found = []
    for lang in sorted(by):
        n = np.array(sorted(by[lang], key=lambda v: v.tobytes()))
        x = model.vectors(n)
        c = spherical_kmeans(x, centroids)
        model.languages += [lang] * len(c)
        model.least = np.concatenate([model.least, [floors(x, n, centroids)] * len(c)])
        found.append(c)
    if found:
        model.centroids = np.concatenate(found).T.astype(np.float32)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = model.predict([t or "" for t in batch.column(2).to_pylist()])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(of, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text isn't rejected, all their columns, in one pass."""
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, rejected = model.predict([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


