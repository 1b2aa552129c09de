"""Tables written in the shared folder, to cut lineage and to pass data between jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders written inside each open ``scratch``.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode, where the session names none (tests)."""
    key = "spark.checkpoint.dir"
    named = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{key} must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="innkeep-")
        spark.conf.set(key, named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> tuple[DataFrame, str]:
    """Write df once as Parquet in the shared folder and read it back; returns the table and its path.

    Inside a ``scratch`` it goes when that ends; without one it stays.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    return materialize(df, name)[0]


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    def __init__(self) -> None:
        self.kept: list[str] = []

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        """df as a table that outlives the scratch."""
        out, path = materialize(df, name)
        self.kept.append(path)
        return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Removes the tables written inside, but for those that ``keep`` wrote: these go to the scratch around it, if any."""
    own = Scratch()
    _open.append([])
    try:
        yield own
    finally:
        paths = _open.pop()
        remove(spark, *[p for p in paths if p not in own.kept])
        if _open:
            _open[-1].extend(own.kept)
