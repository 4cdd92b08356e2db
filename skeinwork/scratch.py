"""Tables between the rounds of iterative operators.

They are written as Parquet below ``spark.checkpoint.dir``, which all executors share, so a lost executor costs a
re-read and not a recomputation of every earlier round. Only a local session without that setting gets a temporary
folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="skeinwork-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return f"file://{_local_root}"


def materialize(df: DataFrame, label: str = "t", codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back; the plan starts anew at the written table."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/skein-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._skein_path = path
    return out


def release(*frames: DataFrame | None) -> None:
    """Delete materialized tables that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_skein_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
