"""Session helpers: intermediate data in the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by `spark.checkpoint.dir`.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidewire-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the work folder now and read it back: computed once, lineage cut."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_work(spark: SparkSession) -> None:
    """Remove the intermediate data this session has written; frames that read it become invalid."""
    jvm = spark.sparkContext._jvm
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
