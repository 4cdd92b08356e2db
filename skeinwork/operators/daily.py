"""Daily figures per subreddit, without imbalance by heavy subreddits, and their audit against stored figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.ranged import run_states
from skeinwork.operators.records import current_rows, norm_name


def daily_metrics(records: DataFrame) -> DataFrame:
    """``day, subreddit, submission_count, comment_count, unique_authors, median_score`` of current records.

    Records without ``created_at`` or subreddit are left out. Null and blank authors are no authors; null scores are
    left out of the exact median, which is null if none is left.
    """
    rows = records.select(
        norm_name("subreddit").alias("subreddit"),
        F.to_date("created_at").alias("day"),
        "score",
        F.when(norm_name("author") != "", norm_name("author")).alias("author"),
        (F.col("source_type") == "submission").alias("submission_count"),
        (F.col("source_type") == "comment").alias("comment_count"),
    ).filter("day IS NOT NULL AND subreddit IS NOT NULL AND subreddit <> ''")
    keys = ["subreddit", "day"]
    scores = run_states(rows, keys, "score", ["submission_count", "comment_count"])
    authors = run_states(rows, keys, "author").select(*keys, F.col("n_distinct").alias("unique_authors"))
    middle = (F.col("low").cast("double") + F.col("high").cast("double")) / 2
    return scores.select(*keys, "submission_count", "comment_count", middle.alias("median_score")).join(authors, keys)


def audit_daily(records: DataFrame, stored: DataFrame) -> DataFrame:
    """``day`` (text) and ``subreddit`` for which the stored row and the records differ or one of them is missing.
    Stored rows without subreddit are left out; if a key has several different rows, one that differs counts."""
    figures = ["submission_count", "comment_count", "unique_authors", "median_score"]
    mine = daily_metrics(records).select("day", "subreddit", *[F.col(c).alias(f"own_{c}") for c in figures], F.lit(True).alias("own"))
    theirs = stored.select("day", norm_name("subreddit").alias("subreddit"), *figures, F.lit(True).alias("there"))
    theirs = theirs.filter("day IS NOT NULL AND subreddit IS NOT NULL AND subreddit <> ''").distinct()
    both = mine.join(theirs, ["day", "subreddit"], "full")
    equal = F.col("own").isNotNull() & F.col("there").isNotNull()
    for c in figures:
        equal = equal & F.col(c).eqNullSafe(F.col(f"own_{c}"))
    return both.filter(~equal).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "subreddit").distinct()


def records_for_metrics(docs: DataFrame) -> DataFrame:
    return current_rows(docs, ["source_type", "subreddit", "author", "created_at", "score"])
