"""What distributed operators need of a session: a shared folder, and this package on the executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    A cluster names it in ``spark.checkpoint.dir``; only in local mode, where one machine has all, a temporary folder is used if that is unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="farelane-"))
        held = sc._jsc.sc().getCheckpointDir()
    return held.get()


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def path_of(spark: SparkSession, path: str):
    """(path, file system) of the JVM."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def put(spark: SparkSession, local: str, target: str) -> None:
    """Copies a file of the driver to a place that executors can read."""
    at, fs = path_of(spark, target)
    fs.mkdirs(at.getParent())
    fs.copyFromLocalFile(False, True, spark._jvm.org.apache.hadoop.fs.Path(f"file://{Path(local).resolve()}"), at)


@contextmanager
def fetched(spark: SparkSession, path: str) -> Iterator[str]:
    """A file, wherever it is, as one of the driver, for formats that only a local reader can open."""
    at, fs = path_of(spark, path)
    if fs.getScheme() == "file":
        yield at.toUri().getPath()
        return
    with tempfile.TemporaryDirectory(prefix="farelane-") as folder:
        fs.copyToLocalFile(False, at, spark._jvm.org.apache.hadoop.fs.Path(f"file://{folder}/{at.getName()}"), True)
        yield f"{folder}/{at.getName()}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each context."""
    sc = spark.sparkContext
    if not getattr(sc, "_farelane_shipped", False):
        package = Path(__file__).resolve().parent
        at = Path(tempfile.mkdtemp(prefix="farelane-")).resolve()
        shutil.copytree(package, at / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(str(at / package.name), "zip", at / "src"))
        sc._farelane_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """For operators that checkpoint or run Python on the executors."""
    shared_dir(spark)
    ship(spark)
    return spark
