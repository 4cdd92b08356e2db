"""Writers: Parquet and CSV, whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _fs(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()), target, jvm.org.apache.hadoop.fs.Path


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> dict[str, object]:
    """Written beside ``path`` with ZSTD, counted on the way, and renamed. Without rows nothing is left behind."""
    beside = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(beside)
    rows = seen.get["rows"]
    fs, target, new_path = _fs(df, path)
    if not rows:
        fs.delete(new_path(beside), True)
        return {"status": "completed_zero_rows", "rows": 0, "path": None}
    fs.delete(target, True)
    if not fs.rename(new_path(beside), target):
        raise OSError(f"could not publish {path}")
    return {"status": "completed", "rows": rows, "path": path}


def write_csv(df: DataFrame, path: str, null: str | None = None, most: int = 1_000_000) -> int:
    """CSV with a header in the folder ``path``: one file for up to ``most`` rows, beyond that one per partition. ``null`` is
    what stands for null."""
    seen = Observation()
    small = df.limit(most + 1).count() <= most
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = (writer.coalesce(1) if small else writer).write.mode("overwrite").option("header", True).option("escape", '"')
    if null is not None:
        writer = writer.option("nullValue", null).option("emptyValue", null)
    writer.csv(path)
    return seen.get["rows"]


def insert_new(new: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose keys are not there yet, each once."""
    new = new.dropDuplicates(keys)
    return new if existing is None else new.join(existing.select(*keys), keys, "left_anti")
