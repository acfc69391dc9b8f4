"""Exact dedup: tree-merge of sorted digest runs (operator 4, native).

Every row is reduced to a digest of its normalised text. Rows are dealt to ``FAN**rounds`` runs; the number of rounds follows from the number
of rows. A run is kept as sorted arrays of entries (digest, smallest identifier, count), one for each range of digests, of about ``ENTRIES``
entries. Level 0 reduces each run to one entry a digest and sorts it. In each round runs exchange and merge in groups of
``FAN`` (a binomial tree of radix 4): each cuts its arrays into ``FAN`` narrower ranges, which keep their order, and for each
range one array is merged from the sorted arrays of the ``FAN`` runs: they are put one after another and sorted by a sort that finds ascending
runs and merges them (TimSort, which array sorts of the JVM are), then neighbours with one digest become one entry with the smallest identifier. After the last round
one run is left. As ranges narrow as runs merge, no array grows, and no merge gathers a run in one task; a digest held by a third of all rows
has one entry in a run after level 0. The winners go back down to the runs of level 0, so the final join also sees a hot
digest spread over all runs.

A digest is verified at every level: two entries meet only if SHA-256, length in bytes and an independent
64-bit hash agree.

Nulls and edges: null text is empty text. A null doc_id sorts after all others. Rows that repeat a
doc_id with the same text are separate rows, of which one is kept. An empty table gives no rows.
Other columns are ignored by ``dedup_groups`` and passed through by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep_rows, let, prepare, table, text_mark

#: Runs that one round merges; rows of a run of level 0 at most (about), if there are more than FAN**LEAST_ROUNDS; entries of an array.
FAN, RUN_ROWS, LEAST_ROUNDS, ENTRIES = 4, 1 << 22, 2, 1024
WHITE = r"[\x20\x09-\x0D]+"
KEY = ["sha", "bytes", "other"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def rounds_for(rows: int) -> int:
    rounds = LEAST_ROUNDS
    while rows > RUN_ROWS * FAN**rounds:
        rounds += 1
    return rounds


def digest_rows(docs: DataFrame) -> DataFrame:
    """One short row per document: id, digest, and a row number that stays fixed once checkpointed."""
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark().alias("mark"), normalised(F.col("text")).alias("norm"))
    return norm.select(
        "doc_id",
        "mark",
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
        F.octet_length("norm").alias("bytes"),
        F.xxhash64("norm").alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )


def in_runs(digests: DataFrame, rounds: int) -> DataFrame:
    return digests.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(FAN**rounds)))


def range_of(prefix: Column, ranges: int) -> Column:
    """Number of the range of a digest whose first four bytes are ``prefix``; ranges of equal width."""
    return F.shiftright(prefix * F.lit(ranges).cast("long"), 32)


def narrower(number: Column, ranges: int) -> Column:
    """A range and its entries, of an array of a wider one."""
    return F.struct(number.alias("range"), F.filter("run_part", lambda e: range_of(e["prefix"], ranges) == number).alias("run_part"))


def reduced(entries: Column) -> Column:
    """Of sorted entries one for each digest: neighbours become one, with the first one's identifier and the sum of counts."""
    key = lambda e: F.struct(*[e[k] for k in KEY])

    def heads(s: Column) -> Column:
        first = lambda i: (i == 0) | (key(F.get(s, i)) != key(F.get(s, i - 1)))
        return F.filter(F.sequence(F.lit(0), F.size(s) - 1), first)

    def one(s: Column, at: Column, k: Column) -> Column:
        start = F.get(at, k)
        length = F.coalesce(F.get(at, k + 1), F.size(s)) - start
        n = F.when(length == 1, F.get(s, start)["n"]).otherwise(F.aggregate(F.slice(s, start + 1, length), F.lit(0).cast("long"), lambda t, e: t + e["n"]))
        return F.get(s, start).withField("n", n)

    whole = lambda s: let(heads(s), lambda at: F.when(F.size(at) == F.size(s), s).otherwise(F.transform(at, lambda _, k: one(s, at, k))))
    return let(entries, lambda s: F.when(F.size(s) < 2, s).otherwise(whole(s)))


def merge_runs(digests: DataFrame, rounds: int, ranges: int = 1) -> tuple[DataFrame, list[DataFrame]]:
    """(level 0 as rows, the levels): runs as sorted arrays; the last level has one run. ranges: of a run at level 0."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")).alias("first")
    lowest = digests.select(*KEY, "run", first).groupBy(*KEY, "run").agg(F.min("first").alias("first"), F.count("*").alias("n"))
    prefix = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    entry = F.struct(prefix.alias("prefix"), *KEY, "first", "n")
    level = lowest.select("run", entry.alias("e")).groupBy("run", range_of(F.col("e.prefix"), ranges).alias("range")).agg(F.sort_array(F.collect_list("e")).alias("run_part"))
    levels = [level]
    for _ in range(rounds):
        ranges *= FAN
        parts = F.array(*[narrower(F.col("range") * FAN + c, ranges) for c in range(FAN)])
        sent = level.select(F.shiftright("run", FAN.bit_length() - 1).alias("run"), F.inline(F.filter(parts, lambda x: F.size(x["run_part"]) > 0)))
        level = sent.groupBy("run", "range").agg(F.flatten(F.collect_list("run_part")).alias("parts")).select("run", "range", reduced(F.sort_array("parts")).alias("run_part"))
        levels.append(level)
    return lowest, levels


def entries_of(level: DataFrame) -> DataFrame:
    return level.select("run", F.explode("run_part").alias("e")).select("run", *[F.col(f"e.{k}").alias(k) for k in (*KEY, "first", "n")])


def dedup_groups(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, mark."""
    prepare(docs.sparkSession)
    digests = digest_rows(docs).checkpoint()  # read three times below; row numbers stay
    n = digests.count()
    rounds = rounds_for(n) if rounds is None else rounds
    digests = in_runs(digests, rounds)
    lowest, levels = merge_runs(digests, rounds, max(1, n // (FAN**rounds * ENTRIES)))
    down = lowest.select(*KEY, "run").join(entries_of(levels[-1]).drop("run"), KEY)
    return digests.join(down, [*KEY, "run"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "mark",
    )


def dedup(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns."""
    return keep_rows(docs, dedup_groups(docs, rounds=rounds))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_groups(table(spark, sf_dir, "documents")).drop("mark")


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n
"""
