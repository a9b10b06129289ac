"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the six ASCII white-space characters that separate words
WORD_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="posegrid-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and any executor may be lost after.

    Unlike ``checkpoint()``, which runs the last stage a second time to write it, this runs it once.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    if _NOTED:
        _NOTED[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: lists that take the paths of ``written``, the innermost last
_NOTED: list[list[str]] = []


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Within the block ``written`` adds the paths of its tables to ``paths``."""
    _NOTED.append(paths)
    try:
        yield
    finally:
        _NOTED.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``written`` that nothing reads any more, and empty the list."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in paths:
        path = hadoop.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint (small frames inside loops)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its columns of these names, in any case: results of an operator replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shards_for(rows: int, per_shard: int) -> int:
    return max(1, math.ceil(rows / per_shard))
