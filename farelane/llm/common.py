"""What the operators of this subpackage share: session settings, reading, checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import cluster
from ..cluster import fresh_folder as fresh_folder

#: Rows and bytes of one Arrow batch sent to Python.
ARROW_ROWS, ARROW_BYTES = 2000, 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches, name a folder for checkpoint(), and send this package to the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return cluster.prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def discard(done: DataFrame) -> None:
    """Deletes the files of a checkpointed table that nothing reads any more."""
    plan = done._jdf.queryExecution().logical()
    at = plan.rdd().getCheckpointFile()
    if at.isDefined():
        path = done.sparkSession._jvm.org.apache.hadoop.fs.Path(at.get())
        path.getFileSystem(done.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often and deep in higher-order functions body names it.

    Without it the optimizer may put a column's expression into a lambda that uses the column, to be computed for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_mark(text: str = "text") -> Column:
    """A hash that tells rows with one doc_id apart by their whole text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose decision (doc_id, mark, kept) is to stay, with all their columns.

    Losers go by doc_id. Only ids that occur more than once, or null, are settled by text as well: of rows that
    share both, as many stay as were decided to (they are equal in what was decided upon).
    """
    decided = decided.select("doc_id", "mark", "kept").checkpoint()
    odd = decided.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").select("doc_id").checkpoint()
    lost = decided.filter("NOT kept").select("doc_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("whole"))  # no name of docs can clash
    if odd.isEmpty():
        return rows.join(lost, "doc_id", "left_anti").select("whole.*")
    known = odd.select(F.col("doc_id").alias("id"))
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    plain = rows.join(known, same, "left_anti").join(lost, "doc_id", "left_anti").select("whole.*")
    left = decided.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("of")).agg(F.count_if("kept").alias("n_left"))
    some = rows.join(known, same, "left_semi").withColumn("mark", text_mark("whole.text"))
    some = some.withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy(F.xxhash64("whole"))))
    return plain.unionByName(some.join(left, same & (F.col("mark") == F.col("of"))).filter("k <= n_left").select("whole.*"))
