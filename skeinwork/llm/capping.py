"""Capping records per dominant contributor.

Rows are sorted globally by contributor and descending quality; partition counts, summed up, give every row its exact
position, the start of its contributor is subtracted, and positions from the cap on have to go.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.ranged import run_positions


def ranked(df: DataFrame, contributor: Sequence[str], quality: str, tie: str) -> DataFrame:
    """``df`` with ``position``, the 0-based place within the contributor: highest ``quality`` first, null qualities
    last, equal ones by the smaller ``tie``. Rows that are equal in both are exchangeable but still counted one by one.
    A null contributor is a contributor here; exempt it beforehand where it should not be limited."""
    return run_positions(df, contributor, [F.col(quality).desc_nulls_last(), F.col(tie).asc_nulls_last()]).drop("prefix")


def cap(
    df: DataFrame,
    contributor: Sequence[str],
    quality: str,
    tie: str,
    most: int | None = None,
    share: float | None = None,
    limited: Column | None = None,
) -> DataFrame:
    """``df`` with the boolean ``kept``: each contributor keeps ``most`` rows, or ``floor(share * rows of df)``.

    ``limited`` tells which rows are subject to the cap; the others are all kept. Empty tables give empty results.
    """
    if (most is None) == (share is None):
        raise ValueError("give either most or share")
    most = most if most is not None else math.floor(Fraction(str(share)) * df.count())
    limited = F.lit(True) if limited is None else F.coalesce(limited, F.lit(False))
    places = ranked(df.filter(limited), contributor, quality, tie)
    kept = places.withColumn("kept", F.col("position") < most).drop("position")
    return kept.unionByName(df.filter(~limited).withColumn("kept", F.lit(True)))
