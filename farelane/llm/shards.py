"""Sharding by size-tiered compaction (operator 8, native).

A store is a folder of immutable Parquet shards and of versions; the newest version's manifest says which shards hold the rows. ``append``
writes arrivals as small shards and commits a manifest that has them besides. ``compact`` sorts the shards below the target size
into tiers by size (a tier spans a factor of ``FANOUT``), and merges each tier of at least ``FANOUT`` shards into files of about the
target size; shards that aren't due stay as they are. Merging reads a tier's shards into one partition for each new file, without a shuffle.

    data/<write>/part-*.parquet    shards; <write> is the version it is meant for, and a number
    writing/<write>                a writer that hasn't committed or given up
    entries/<id>/                  a manifest: a row for each shard
    versions/v00000001             which manifest and columns a version has

A commit creates its version's file if there is none, which the file system decides: a commit happens as a whole or not at all, and of two
writers one has to start again. A version's file without content is no version (its writer was lost in between); after ``GRACE`` seconds its number is
passed over. What a lost executor or driver leaves behind is named in no manifest. ``vacuum`` deletes shards that
no version of the retention time names, of writers that aren't at work; so readers of such a version and open appends aren't disturbed.

Manifests are written, joined and planned as DataFrames. The driver gets the tiers, and lists of paths, as Spark's reader needs them: those of
at most ``STEP`` shards at a time to merge, and those of a version to read.

Edges: rows are kept as they are: nulls, repeated rows, any columns (``_metadata`` and ``_shard`` excepted). Appends may have different
columns: a version has those of all its shards, null where a shard lacks one; an append that gives a column another type or another
case of its name is refused before anything is written. An empty append commits a version without new shards.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import fresh_folder, table

MB = 1 << 20
TARGET = 64 * MB
FANOUT = 4
#: Rows of a shard as it arrives, at most.
ARRIVAL_ROWS = 8192
#: Shards merged by one job, at most.
STEP = 50_000
#: Seconds after which a version's empty file is taken for a lost writer's; seconds for which superseded versions can be read.
GRACE, RETENTION = 3600.0, 7 * 24 * 3600.0
ENTRY = "shard string, bytes long, n_rows long, tier int, since int"


def tier_of(size: Column, target: int = TARGET, fanout: int = FANOUT) -> Column:
    """0 for shards of the target size (its half or more), 1 for those up to fanout times smaller, and so on."""
    return F.greatest(F.lit(0), F.ceil(F.log(F.lit(target / 2) / F.greatest(size, F.lit(1))) / F.log(F.lit(float(fanout))))).cast("int")


@dataclass
class Store:
    spark: SparkSession
    root: str
    target: int = TARGET
    fanout: int = FANOUT

    # files

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, name: str) -> list[tuple[str, int, float]]:
        """(name, bytes, seconds of its last change) of what a folder holds."""
        path, fs = self._at(name)
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime() / 1000) for s in fs.listStatus(path)] if fs.exists(path) else []

    def _create(self, name: str, content: str) -> bool:
        """Makes a file unless there is one."""
        path, fs = self._at(name)
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if fs.exists(path):
                return False
            raise e
        out.write(content.encode())
        out.close()
        return True

    def _delete(self, name: str) -> bool:
        path, fs = self._at(name)
        return bool(fs.delete(path, True))

    # versions

    def version(self) -> int:
        """The newest committed version; 0 if there is none."""
        return max((int(n[1:]) for n, size, _ in self._list("versions") if size), default=0)

    def _said(self, version: int) -> dict:
        path, fs = self._at(f"versions/v{version:08}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/entries/{self._said(version)['entries']}")

    def schema(self, version: int | None = None) -> StructType:
        """Of the rows of a version: the columns of all its shards."""
        version = self.version() if version is None else version
        return StructType.fromJson(self._said(version)["schema"]) if version else StructType()

    def commit(self, entries: DataFrame, schema: StructType, base: int) -> int:
        """Makes the entries the version after base; raises if someone else has."""
        name, now = uuid.uuid4().hex, time.time()
        entries.coalesce(4).write.parquet(f"{self.root}/entries/{name}")
        lost = {int(n[1:]) for n, size, at in self._list("versions") if not size and now - at > GRACE}
        version = base + 1
        while version in lost:
            version += 1
        if self.version() != base or not self._create(f"versions/v{version:08}", json.dumps({"entries": name, "schema": schema.jsonValue()})):
            self._delete(f"entries/{name}")
            raise RuntimeError(f"version {version} has been committed by another writer")
        return version

    # rows

    def _write(self, rows: DataFrame, base: int, most_rows: int = 0) -> tuple[str, DataFrame]:
        """Writes rows as shards, a file each; the name of the write, which stays marked as at work, and its entries."""
        k = 0
        while self._list(f"data/{(name := f'v{base + 1:08}-{k}')}") or not self._create(f"writing/{name}", ""):
            k += 1
        rows.write.option("maxRecordsPerFile", most_rows).parquet(f"{self.root}/data/{name}")
        held = self.spark.read.schema(rows.schema).parquet(f"{self.root}/data/{name}")
        held = held.groupBy(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("n_rows"))
        tier = tier_of(F.col("bytes"), self.target, self.fanout)
        return name, held.select(F.concat(F.lit(f"data/{name}/"), "file").alias("shard"), "bytes", "n_rows", tier.alias("tier"), F.lit(base + 1).alias("since"))

    def append(self, rows: DataFrame, most_rows: int = ARRIVAL_ROWS) -> int:
        base = self.version()
        schema = self.schema(base)
        known = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in schema}
        odd = [f.name for f in rows.schema if known.get(f.name.lower(), (f.name, f.dataType.simpleString())) != (f.name, f.dataType.simpleString())]
        if odd:
            raise ValueError(f"columns that the store has in another type or case: {', '.join(odd)}")
        schema = StructType([*schema, *(StructField(f.name, f.dataType, True) for f in rows.schema if f.name.lower() not in known)])
        name, new = self._write(rows, base, most_rows)
        try:
            return self.commit(self.manifest(base).unionByName(new), schema, base)
        finally:
            self._delete(f"writing/{name}")

    def compact(self) -> int:
        """Merges every tier that is due; returns the newest version (the same if none was)."""
        base = self.version()
        held, schema = self.manifest(base), self.schema(base)
        due = held.filter("tier > 0").groupBy("tier").agg(F.count("*").alias("n")).filter(F.col("n") >= self.fanout).collect()  # a row a tier
        if not due:
            return base
        writes, entries = [], held.filter(~F.col("tier").isin([t["tier"] for t in due]))
        try:
            for t in sorted(due):
                parts = -(-t["n"] // STEP)
                for k in range(parts):
                    some = held.filter((F.col("tier") == t["tier"]) & (F.pmod(F.xxhash64("shard"), F.lit(parts)) == k)).select("shard", "bytes").collect()
                    if some:
                        merged = self.spark.read.schema(schema).parquet(*[f"{self.root}/{e['shard']}" for e in some])
                        name, new = self._write(merged.coalesce(max(1, round(sum(e["bytes"] for e in some) / self.target))), base)
                        writes.append(name)
                        entries = entries.unionByName(new)
            return self.commit(entries, schema, base)
        finally:
            for name in writes:
                self._delete(f"writing/{name}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with the shard each is in as ``_shard``."""
        version = self.version() if version is None else version
        shards = self.manifest(version).select("shard").collect()
        name = F.concat_ws("/", F.lit("data"), F.slice(F.split("_metadata.file_path", "/"), -2, 2))
        if not shards:
            return self.spark.createDataFrame([], self.schema(version)).withColumn("_shard", F.lit(None).cast("string"))
        return self.spark.read.schema(self.schema(version)).parquet(*[f"{self.root}/{e['shard']}" for e in shards]).select("*", name.alias("_shard"))

    def vacuum(self, retention: float = RETENTION) -> int:
        """Deletes shards that no version of the last ``retention`` seconds names, except those of writers at work; returns their number."""
        if not self._list("data"):
            return 0
        since = time.time() - retention
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{self.root}/data")  # listed here
        old = files.filter(F.col("modificationTime") <= F.lit(datetime.fromtimestamp(since + 1, UTC))).select(F.concat_ws("/", F.lit("data"), F.slice(F.split("path", "/"), -2, 2)).alias("shard"))
        for name, _, at in self._list("writing"):  # after the files, and before the versions: who commits meanwhile is seen in either
            if at <= since and retention:
                self._delete(f"writing/{name}")
            else:
                old = old.filter(~F.col("shard").startswith(f"data/{name}/"))
        versions = sorted((int(n[1:]), at) for n, size, at in self._list("versions") if size)
        # a version can be read until ``retention`` after the next one came
        for k, (v, _) in enumerate(versions):
            if k == len(versions) - 1 or versions[k + 1][1] > since:
                old = old.join(self.manifest(v).select("shard"), "shard", "left_anti")
        return sum(self._delete(r["shard"]) for r in old.toLocalIterator())


def settled(store: Store, docs: DataFrame) -> int:
    """Appends documents to a store and compacts it; the newest version."""
    store.append(docs)
    version = store.compact()
    store.vacuum(0)
    return version


def placed(docs: DataFrame, target: int = TARGET) -> DataFrame:
    """Where each document is in a new, compacted store: doc_id, text_sha256, shard, shard_bytes, shard_rows, found_rows (of the shard), tier, due (shards of
    the tier that are to be merged), version."""
    spark = docs.sparkSession
    store = Store(spark, fresh_folder(spark, "shards"), target)
    version = settled(store, docs)
    entries = store.manifest(version).select("shard", F.col("bytes").alias("shard_bytes"), F.col("n_rows").alias("shard_rows"), "tier")
    tiers = entries.groupBy("tier").agg(F.count("*").alias("n")).select("tier", F.when((F.col("tier") > 0) & (F.col("n") >= store.fanout), F.col("n")).otherwise(0).alias("due"))
    rows = store.read(version)
    entries = entries.join(tiers, "tier").join(rows.groupBy(F.col("_shard").alias("shard")).agg(F.count("*").alias("found_rows")), "shard", "left")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"), F.col("_shard").alias("shard"))
    return rows.join(entries, "shard", "left").select("doc_id", "text_sha256", "shard", "shard_bytes", "shard_rows", "found_rows", "tier", "due", F.lit(version).alias("version"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as the compacted store holds it; which file it is in depends on how the arrivals were cut, so only what must hold of it is returned."""
    docs = placed(table(spark, sf_dir, "documents"))
    fits = F.coalesce((F.col("shard_rows") == F.col("found_rows")) & (F.col("shard_bytes") <= 2 * TARGET), F.lit(False))
    return docs.select("doc_id", "text_sha256", fits.alias("in_a_listed_shard"), F.coalesce(F.col("due") == 0, F.lit(False)).alias("compacted"))


SQL = "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, true AS in_a_listed_shard, true AS compacted FROM documents"
