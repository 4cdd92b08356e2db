"""Discovery marts, evidence selections and the tables of the query layer over signals, entities and documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first(rows: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """The newest rows of each group, equal times by id; rank and cut become one group limit before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("created_at").desc_nulls_last(), F.col("source_id").asc_nulls_last()))
    return rows.withColumn("evidence_rank", rank).filter(F.col("evidence_rank") <= most)


def _newest() -> Column:
    """The newest row of a group as its evidence, equal times by id: an aggregate, combined before the shuffle."""
    shown = F.struct("source_type", "source_id", "subreddit", "created_at", F.left("evidence_text", F.lit(300)).alias("evidence_snippet"))
    order = F.struct(F.col("created_at").isNull(), -F.unix_micros(F.col("created_at").cast("timestamp")), F.col("source_id").isNull(), F.col("source_id"))
    return F.min_by(shown, order).alias("best")


def discovery(signals: DataFrame, kinds: Sequence[str], by: Sequence[str], most: int = 50) -> DataFrame:
    """Counts of signals per ``by``, which names a topic, with their newest evidence. A null and an empty topic share their
    evidence; a null community has counts but no evidence. Signals are read once."""
    rows = signals.filter(F.col("signal_type").isin(*kinds))
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("signal_count"), _newest())
    others = [c for c in by if c != "topic_hint"]
    # one or two topics to a row: null and empty
    met = groups.groupBy(*others, F.coalesce("topic_hint", F.lit("")).alias("_t")).agg(F.collect_list(F.struct("topic_hint", "signal_count", "best")).alias("_g"))
    known = F.lit(True)
    for c in others:
        known = known & F.col(c).isNotNull()
    evidence = F.transform("_g", lambda g: g["best"])
    met = met.withColumn("_e", F.when(known, evidence).otherwise(F.slice(F.transform("_g", lambda g: F.nullif(g["best"], g["best"])), 1, 1)))
    joined = met.select(*others, "_e", F.explode("_g").alias("_c")).select(*others, "_c.topic_hint", "_c.signal_count", F.explode("_e").alias("_b"))
    out = joined.select(*by, "signal_count", *[F.col(f"_b.{c}") for c in ("source_type", "source_id", "created_at", "evidence_snippet")])
    return out.orderBy(F.desc("signal_count"), *[F.col(c).asc_nulls_last() for c in by]).limit(most)


def pain_points(signals: DataFrame, most: int = 50) -> DataFrame:
    return discovery(signals, ["pain_point"], ["subreddit", "topic_hint", "matched_pattern"], most)


def app_ideas(signals: DataFrame, most: int = 50) -> DataFrame:
    return discovery(signals, ["feature_request", "recommendation_request", "workaround"], ["subreddit", "signal_type", "topic_hint", "matched_pattern"], most)


def entities_and_workarounds(mentions: DataFrame, most: Mapping[str, int]) -> DataFrame:
    """The most frequent results of each kind with their newest evidence, from ``enrich.mentions``: ``most`` rows of each
    ``result_kind``. Rows are read and counted once; the rank is one over groups, of which there are as many as rules."""
    by = ["result_kind", "result_category", "result_label"]
    groups = mentions.groupBy(*by).agg(F.count(F.lit(1)).alias("result_count"), _newest())
    rank = F.row_number().over(Window.partitionBy("result_kind").orderBy(F.desc("result_count"), "result_category", "result_label"))
    limit = F.lit(0)
    for kind, n in most.items():
        limit = F.when(F.col("result_kind") == kind, n).otherwise(limit)
    top = groups.withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    return top.select(*by, "result_count", *[F.col(f"best.{c}") for c in ("source_type", "source_id", "subreddit", "created_at", "evidence_snippet")]).orderBy("result_kind", F.desc("result_count"), "result_category", "result_label")


def evidence_groups(signals: DataFrame, kind: str, most_groups: int, examples: int) -> tuple[DataFrame, DataFrame]:
    """The largest groups of one signal type, and up to ``examples`` newest rows of each."""
    by = ["signal_type", "topic", "matched_pattern"]
    rows = signals.filter(F.col("signal_type") == kind).withColumn("topic", F.coalesce("topic_hint", F.lit("unclassified")))
    top = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("signal_count"), F.countDistinct("subreddit").alias("subreddit_count"))
    top = top.orderBy(F.desc("signal_count"), F.desc("subreddit_count"), *by).limit(most_groups)
    kept = rows.join(F.broadcast(top.select(*by, "signal_count")), by)  # at most most_groups rows
    return top, _first(kept, by, examples).select(*by, "signal_count", "evidence_rank", "source_type", "source_id", "subreddit", "created_at", F.left("evidence_text", F.lit(500)).alias("evidence_text"))
