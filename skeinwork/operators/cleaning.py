"""From raw rows to clean records: the latest row of each id, normalised text, and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.functions.text import collapse, is_bot, is_deleted, is_removed, once

# fixed values: how texts of bots begin
BOT_STARTS = ("i am a bot", "this action was performed automatically", "beep boop")


def latest(raw: DataFrame) -> DataFrame:
    """One row per ``id``: latest ``ingested_at``, then first ``source_file``; ``raw_duplicate_count`` tells of how many.
    Rank and count share one window and so one shuffle. Null ids are one id, as in the raw layer."""
    by_id = Window.partitionBy("id")
    newest = by_id.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("source_file").asc_nulls_last())
    ranked = raw.withColumns({"raw_duplicate_count": F.count(F.lit(1)).over(by_id), "_rank": F.row_number().over(newest)})
    return ranked.filter("_rank = 1").drop("_rank")


def clean_comments(raw: DataFrame, run_id: str = "clean") -> DataFrame:
    """``raw`` has ``id, author, subreddit, body`` and provenance. Text is trimmed of blanks first and white space collapsed
    then, so a text that begins with a line break keeps one blank."""
    rows = once(latest(raw), body_clean=collapse(F.trim(F.coalesce("body", F.lit("")))))
    return rows.withColumns(
        {
            "is_deleted": is_deleted(F.col("body")),
            "is_removed": is_removed(F.col("body")),
            "is_bot_like": is_bot(F.col("author"), F.col("body"), BOT_STARTS),
        }
    ).withColumns({"text_length": F.length("body_clean").cast("long"), "language": F.lit(None).cast("string"), "raw_id": F.col("id"), "clean_run_id": F.lit(run_id)})


def clean_submissions(raw: DataFrame, run_id: str = "clean") -> DataFrame:
    """``raw`` has ``title`` and ``selftext``; both, or the one that is there, make ``combined_text``. What a bot's text
    begins with is looked for in the title, a blank and the text, none of them trimmed."""
    rows = latest(raw)
    rows = once(rows, title_clean=collapse(F.trim(F.coalesce("title", F.lit("")))), selftext_clean=collapse(F.trim(F.coalesce("selftext", F.lit("")))))
    both = F.concat("title_clean", F.lit("\n\n"), "selftext_clean")
    combined = F.when(F.col("selftext_clean") == "", F.col("title_clean")).when(F.col("title_clean") == "", F.col("selftext_clean")).otherwise(both)
    return once(rows, combined_text=combined).withColumns(
        {
            "is_deleted": is_deleted(F.col("title")) | is_deleted(F.col("selftext")),
            "is_removed": is_removed(F.col("title")) | is_removed(F.col("selftext")),
            "is_bot_like": is_bot(F.col("author"), F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("selftext", F.lit(""))), BOT_STARTS),
        }
    ).withColumns({"text_length": F.length("combined_text").cast("long"), "language": F.lit(None).cast("string"), "raw_id": F.col("id"), "clean_run_id": F.lit(run_id)})


def is_usable(text: str) -> Column:
    """Whether enrichment looks at a clean row."""
    return ~F.col("is_deleted") & ~F.col("is_removed") & ~F.col("is_bot_like") & (F.col("text_length") > 0) & (F.trim(F.col(text)) != "")


def usable(clean: DataFrame, text: str) -> DataFrame:
    return clean.filter(is_usable(text))


def documents(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Both kinds in one form, ``text`` being what is analysed."""
    shared = ["author", "subreddit", "score", "created_at", "source_file", "manifest_id", "clean_run_id", "raw_id", "text_length", "is_deleted", "is_removed", "is_bot_like", "raw_duplicate_count"]
    c = comments.select(F.lit("comment").alias("source_type"), F.col("id").alias("source_id"), F.col("body_clean").alias("text"), "link_id", "parent_id", *shared)
    s = submissions.select(F.lit("submission").alias("source_type"), F.col("id").alias("source_id"), F.col("combined_text").alias("text"), F.lit(None).cast("string").alias("link_id"), F.lit(None).cast("string").alias("parent_id"), *shared)
    return c.unionByName(s)
