"""Reproducible samples that stay as data grows: frozen batches, bottom-k by salted hash.

Within each immutable arrival batch exactly ``ceil(rate * size)`` identifiers with the smallest salted hashes are kept.
Later batches have their own picks, so the union only grows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.llm.joining import attach
from skeinwork.operators.ranged import run_positions


def salted_hash(identifier: str, salt: str) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}:"), F.col(identifier)))


def frozen_sample(arrivals: DataFrame, identifier: str, batch: str, rate: float, salt: str) -> DataFrame:
    """``identifier`` and ``batch`` of the picked identifiers.

    Rows without identifier or batch are left out. An identifier belongs to the first (smallest) batch it occurs in and
    counts once there. Ties of the hash fall to the smaller identifier. ``rate`` 0 or an empty table gives no rows,
    ``rate`` 1 all identifiers; other columns are ignored.
    """
    if not 0 <= rate <= 1:
        raise ValueError("rate must be in [0, 1]")
    first = arrivals.filter(F.col(identifier).isNotNull() & F.col(batch).isNotNull()).groupBy(identifier).agg(F.min(batch).alias(batch))
    hashed = first.withColumn("_h", salted_hash(identifier, salt))
    placed = run_positions(hashed, [batch], [F.col("_h").asc(), F.col(identifier).asc()])
    sizes = placed.groupBy(batch).agg((F.max("position") + 1).alias("_size"))
    limited = attach(placed, sizes, [batch], identifier, sizes.count(), "_size")
    # the product is rounded before ceil, so that 0.1 * 30 is 3 and not 4
    return limited.filter(F.col("position") < F.ceil(F.round(F.lit(float(rate)) * F.col("_size"), 9))).select(identifier, batch)


def extend_sample(ledger: DataFrame, arrivals: DataFrame, identifier: str, batch_name: str, rate: float, salt: str, batch: str | None = None) -> DataFrame:
    """The rows that a new arrival adds to ``ledger``: ``identifier``, ``batch`` and ``picked`` of every identifier that the
    ledger does not know yet. They are one new batch or, where a column ``batch`` is named, a new batch for each of its
    (smallest) values, ``<batch_name>/<value>``; rows without one are left for a later arrival. Appending them leaves all
    earlier picks as they are."""
    named = F.concat(F.lit(f"{batch_name}/"), F.col(batch).cast("string")) if batch else F.lit(batch_name)
    new = arrivals.select(identifier, named.alias("batch")).filter(F.col(identifier).isNotNull() & F.col("batch").isNotNull()).groupBy(identifier).agg(F.min("batch").alias("batch"))
    new = new.join(ledger.select(identifier), identifier, "left_anti")
    picks = frozen_sample(new, identifier, "batch", rate, salt).select(identifier, F.lit(True).alias("_p"))
    return new.join(picks, identifier, "left").select(identifier, "batch", F.coalesce("_p", F.lit(False)).alias("picked"))


def keep_sample(folder: str, arrivals: DataFrame, identifier: str, rate: float, salt: str, batch: str | None = None) -> DataFrame:
    """``identifier`` and ``batch`` of the picks of all arrivals so far. ``folder`` holds the ledger, a folder of Parquet to
    each arrival. What the ledger does not know yet is added by ``extend_sample``, and shows only once it is written in
    full; an arrival that another run adds at the same time is an error."""
    spark = arrivals.sparkSession
    schema = T.StructType([T.StructField(identifier, arrivals.schema[identifier].dataType), T.StructField("batch", T.StringType()), T.StructField("picked", T.BooleanType())])
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    known = sorted(x.getPath().toString() for x in files.listStatus(path(folder)) if x.getPath().getName().startswith("batch-")) if files.exists(path(folder)) else []
    ledger = spark.read.schema(schema).parquet(*known) if known else spark.createDataFrame([], schema)
    name = f"batch-{len(known):06}"
    staged, target = path(f"{folder}/_staged-{uuid.uuid4().hex}"), path(f"{folder}/{name}")
    extend_sample(ledger, arrivals, identifier, name, rate, salt, batch).write.parquet(staged.toString())
    added = spark.read.schema(schema).parquet(staged.toString())
    if added.isEmpty():
        files.delete(staged, True)
        return ledger.filter("picked").select(identifier, "batch")
    if files.exists(target) or not files.rename(staged, target):
        files.delete(staged, True)
        raise RuntimeError(f"{target} was added by another run")
    return spark.read.schema(schema).parquet(*known, target.toString()).filter("picked").select(identifier, "batch")
