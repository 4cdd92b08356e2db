"""All pairs within groups, heavy groups spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairs_within(members: DataFrame, key: str, identifier: str, differ: str | None = None, tile: int = 5000) -> DataFrame:
    """``<identifier>_a`` < ``<identifier>_b`` for the pairs of rows with equal ``key`` (and unequal ``differ``, if given).

    Groups are cut into tiles of about ``tile`` rows; a row is sent to every tile of its group and met there by the
    rows that belong to the tile, so that a heavy group becomes many tasks. Null keys form no pairs.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    tiled = members.join(sizes, key).withColumn("_t", F.ceil(F.col("_n") / tile).cast("int")).drop("_n")
    own = F.pmod(F.xxhash64(identifier), F.col("_t")).cast("int")
    extra = [differ] if differ else []
    a = tiled.select(F.col(key).alias("_k"), F.col(identifier).alias(f"{identifier}_a"), *[F.col(c).alias("_da") for c in extra], own.alias("_s"))
    b = tiled.select(F.col(key).alias("_k"), F.col(identifier).alias(f"{identifier}_b"), *[F.col(c).alias("_db") for c in extra], F.explode(F.sequence(F.lit(0), F.col("_t") - 1)).alias("_s"))
    both = a.join(b, ["_k", "_s"]).filter(F.col(f"{identifier}_a") < F.col(f"{identifier}_b"))
    if differ:
        both = both.filter("_da <> _db")
    return both.select(f"{identifier}_a", f"{identifier}_b")
