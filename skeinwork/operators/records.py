"""The current row of each record, and normalised names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm_name(column: str) -> Column:
    """Trimmed and lower-cased; author and subreddit names are compared in this form."""
    return F.lower(F.trim(F.col(column)))


def current_rows(docs: DataFrame, columns: list[str], key: str = "source_id", version: str = "clean_run_id") -> DataFrame:
    """One row per ``key``: that of the greatest ``version``, with ``columns`` only.

    Versions compare as plain strings and a null version is the oldest. Exact copies count once; if rows of one
    version differ all the same, the greatest in the order of ``columns`` is taken, so that the choice does not
    depend on the layout. Rows without a key are left out.
    """
    picked = F.max(F.struct(F.col(version).alias("_v"), *[F.col(c) for c in columns])).alias("_r")
    return (
        docs.filter(F.col(key).isNotNull())
        .groupBy(F.col(key))
        .agg(picked)
        .select(key, *[F.col("_r")[c].alias(c) for c in columns])
    )
