"""Feeds: zip of CSV files to typed, checked tables."""

from __future__ import annotations

import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import fetched, put
from ..schemas import CHECKS, KEYS, NOT_NULL, TABLES, columns


class FeedError(ValueError):
    """A feed that breaks a key, a check or a null rule."""


def table_of(file_name: str) -> str | None:
    """The table that a zip entry fills; the whole path counts, so entries in folders fill none."""
    name = file_name.lower()[:-4]
    return name if name in TABLES else None


def unpack(spark: SparkSession, gtfs_zip: str, folder: str) -> tuple[dict[str, str], list[str]]:
    """Extracts the tables' files to a folder that executors can read (of any file system): paths by table, and the entries that fill no table."""
    paths, others = {}, []
    with fetched(spark, gtfs_zip) as local, zipfile.ZipFile(local) as z, tempfile.TemporaryDirectory(prefix="farelane-") as aside:
        for entry in z.namelist():
            if (table := table_of(entry)) is None:
                others.append(entry)
                continue
            at = Path(aside) / f"{table}.txt"
            with z.open(entry) as source, at.open("wb") as target:
                shutil.copyfileobj(source, target)
            paths[table] = f"{folder}/{table}.txt"
            put(spark, str(at), paths[table])
    return paths, others


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """A line with an odd number of quotes: a quoted value goes on in the next one."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """S3: the table's columns in any order of the header, missing ones null, extra ones dropped, empty strings null.

    A file is split among tasks unless a quoted value in it holds a line break.
    """
    raw = spark.read.csv(path, header=True, multiLine=has_broken_lines(spark, path), escape='"', encoding="UTF-8")
    by_name = {c.strip().lstrip("﻿"): c for c in raw.columns}

    def column(name: str, kind: str) -> Column:
        if name not in by_name:
            return F.lit(None).cast(kind).alias(name)
        text = F.trim(F.col(f"`{by_name[name]}`")) if kind != "string" else F.col(f"`{by_name[name]}`")
        value = F.when(text != "", text)
        return (value if kind == "string" else value.try_cast(kind)).alias(name)

    typed = raw.select(*[column(n, k) for n, k in columns(table)], *[F.col(f"`{by_name[n]}`").alias(f"__{n}") for n, k in columns(table) if k != "string" and n in by_name])
    numbers = [n for n, k in columns(table) if k != "string" and n in by_name]
    wrong = F.lit(False)
    for n in numbers:
        wrong = wrong | (F.col(n).isNull() & (F.trim(F.col(f"__{n}")) != ""))
    return typed.withColumn("__wrong", F.coalesce(wrong, F.lit(False))).drop(*[f"__{n}" for n in numbers])


def violations(df: DataFrame, table: str) -> dict[str, int]:
    """Rows that break a rule, by rule."""
    rules = {f"{c} is null": F.col(c).isNull() for c in [*NOT_NULL.get(table, []), *KEYS.get(table, [])]}
    rules |= {f"not {c}": ~F.coalesce(F.expr(c), F.lit(True)) for c in CHECKS.get(table, [])}
    if "__wrong" in df.columns:
        rules["not a number"] = F.col("__wrong")
    found = {}
    if rules:
        row = df.agg(*[F.count_if(v).alias(f"r{i}") for i, v in enumerate(rules.values())]).first()
        found = {k: row[f"r{i}"] for i, k in enumerate(rules) if row[f"r{i}"]}
    if table in KEYS:
        twice = df.groupBy(*KEYS[table]).agg(F.count("*").alias("n")).filter("n > 1").count()
        if twice:
            found[f"duplicate {', '.join(KEYS[table])}"] = twice
    return found


def checked(df: DataFrame, table: str) -> DataFrame:
    if found := violations(df, table):
        raise FeedError(f"{table}: " + "; ".join(f"{n} rows: {rule}" for rule, n in found.items()))
    return df.drop("__wrong")


def read_feed(spark: SparkSession, gtfs_zip: str, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """All tables of a feed, checked; raises FeedError at the first that breaks a rule, before anything is written."""
    paths, others = unpack(spark, gtfs_zip, folder)
    return {t: checked(read_csv(spark, p, t), t) for t, p in sorted(paths.items())}, others


def keep_origin(spark: SparkSession, gtfs_zip: str, agency_name: str, output_dir: str) -> None:
    """K6."""
    with fetched(spark, gtfs_zip) as local, tempfile.TemporaryDirectory(prefix="farelane-") as aside:
        copy = Path(aside) / "gtfs.zip"  # the feed may be the very file that is replaced
        shutil.copy(local, copy)
        put(spark, str(copy), f"{output_dir}/gtfs.zip")
        (Path(aside) / "AGENCY_NAME").write_text(agency_name.lower())
        put(spark, f"{aside}/AGENCY_NAME", f"{output_dir}/AGENCY_NAME")
