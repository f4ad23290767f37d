"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a scratch one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="querylode-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a columnar table in the shared folder and read it back; for data used several times."""
    return _written(df, f"{_SCRATCH.get()}{name}")


#: The folder, inside the shared one, that the code running now stores in; of its own in every thread and every ``scratch`` block.
_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is stored inside the block goes at its end, except for what the function it yields stores: results that outlive the block
    must rest on such tables or on the block's inputs alone."""
    name, outer = f"scratch-{uuid.uuid4().hex}/", _SCRATCH.get()
    mine = _SCRATCH.set(name)
    try:
        yield lambda df, kept: _written(df, f"{outer}{kept}")
    finally:
        _SCRATCH.reset(mine)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
