"""Where intermediate tables go.

A written table cuts lineage, survives the loss of executors, and has a size the planner
knows: a join with it is broadcast only when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise.
"""

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only for a local master (tests)."""
    global _local_root
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="parcelhouse-")
        root = _local_root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark)}/parcelhouse/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete intermediate tables that have not been written to for so long; returns how many.

    Frames that still read one of them fail afterwards, so the limit should exceed the longest job.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/parcelhouse/*")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [s for s in files.globStatus(at) or [] if s.getModificationTime() < limit]
    for status in old:
        files.delete(status.getPath(), True)
    return len(old)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
