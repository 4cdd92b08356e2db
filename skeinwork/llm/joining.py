"""Attaching a per-key table to rows whose keys may be heavy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: str, size: int, weight: str | None = None, most: int = 200_000) -> DataFrame:
    """Inner join of ``rows`` with ``table``, one row per key, of ``size`` rows.

    Up to ``most`` rows of ``table`` are broadcast. A larger one is joined by key and salt: keys whose ``weight`` (their
    number of rows) is over a million are spread over a thousand tasks by the hash of ``spread``.
    """
    if size <= most:
        return rows.join(F.broadcast(table), list(keys))
    if weight is None:
        return rows.join(table, list(keys))
    heavy = table.filter(F.col(weight) > 1_000_000).select(*keys)
    salts = F.when(F.col(weight) > 1_000_000, F.sequence(F.lit(0), F.lit(999))).otherwise(F.array(F.lit(0)))
    salted = table.withColumn("_salt", F.explode(salts))
    marked = rows.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), list(keys), "left")  # at most one key per million rows
    picked = F.when(F.col("_heavy"), F.pmod(F.xxhash64(spread), F.lit(1000))).otherwise(F.lit(0)).cast("int")
    return marked.withColumn("_salt", picked).drop("_heavy").join(salted, [*keys, "_salt"]).drop("_salt")
