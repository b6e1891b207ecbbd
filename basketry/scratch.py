"""Where jobs put checkpoints and short-lived tables.

On a cluster this is the shared folder named in ``spark.checkpoint.dir``. Only a
local session without that setting gets a folder of its own, which goes when Python ends.
``clear`` deletes what a session has put into the shared folder so far.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; also makes ``checkpoint()`` usable."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="basketry-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return own


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/basketry-{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete one scratch path that nothing reads any more."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    if path in _made:
        _made.remove(path)


def clear(spark: SparkSession) -> None:
    """Delete every scratch path made so far; for the owner of a run, after its last read."""
    while _made:
        delete(spark, _made[-1])


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
