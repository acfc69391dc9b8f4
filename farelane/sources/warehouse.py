"""Stage tables as Parquet, replaced as a whole.

    <schema>/<name>/<write>/       a table as one write left it
    <schema>/<name>/v00000001      names the write that is version 1; the newest version is the table

A version's file is made if there is none, so a table is replaced at one moment, and of two writers one is told that the other was first. The
version before stays for those who read it; older ones are deleted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..cluster import path_of


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        """``schema.table`` to its folder."""
        schema, name = table.split(".")
        return f"{self.root}/{schema}/{name}"

    def versions(self, table: str) -> list[int]:
        path, fs = path_of(self.spark, self.path(table))
        found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[1:]) for n, size in found if n.startswith("v") and n[1:].isdigit() and size)

    def has(self, table: str) -> bool:
        return bool(self.versions(table))

    def folder(self, table: str, version: int) -> str:
        path, fs = path_of(self.spark, f"{self.path(table)}/v{version:08}")
        stream = fs.open(path)
        try:
            return f"{self.path(table)}/{self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
        finally:
            stream.close()

    def write(self, table: str, df: DataFrame, sort: list[str] | None = None) -> DataFrame:
        """Written aside, then made the newest version. With sort the whole table is in that order, file by file (K4). Returns what was written."""
        held = self.versions(table)
        name = uuid.uuid4().hex
        (df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df).write.parquet(f"{self.path(table)}/{name}")
        path, fs = path_of(self.spark, f"{self.path(table)}/v{(held[-1] if held else 0) + 1:08}")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"{table} has been replaced by another writer") from e
        out.write(name.encode())
        out.close()
        for old in held[:-1]:
            for gone in (self.folder(table, old), f"{self.path(table)}/v{old:08}"):
                at, fs = path_of(self.spark, gone)
                fs.delete(at, True)
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        held = self.versions(table)
        if not held:
            raise FileNotFoundError(f"table {table} doesn't exist; run the stage that makes it")
        return self.spark.read.parquet(self.folder(table, held[-1]))
