"""Signals and entities of clean documents.

Rules are unrolled into one array of matches per document, which is exploded: patterns are compiled once, the text is
lower-cased once, and there is no join with the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.text import has_phrase, once
from skeinwork.operators.cleaning import is_usable
from skeinwork.operators.ranged import run_states
from skeinwork.packs import EnrichPack
from skeinwork.scratch import materialize


def topic_hint(lowered: Column, pack: EnrichPack) -> Column:
    """The first entity type, in the pack's order, of which a phrase occurs."""
    hint = None
    for kind in dict.fromkeys(e.entity_type for e in pack.entities):
        found = F.lit(False)
        for e in pack.entities:
            if e.entity_type == kind:
                found = found | has_phrase(lowered, e.phrase)
        hint = F.when(found, kind) if hint is None else hint.when(found, kind)
    return hint if hint is not None else F.lit(None).cast("string")


def _signal_hits(pack: EnrichPack) -> Column:
    """The matching signal rules of a row with ``_low`` and ``topic_hint``, null where there is no text."""
    hits = [
        F.when(has_phrase(F.col("_low"), r.phrase) & (F.col("topic_hint").isNotNull() if r.needs_topic else F.lit(True)), F.struct(F.lit(r.signal_type).alias("signal_type"), F.lit(r.phrase).alias("matched_pattern")))
        for r in dict.fromkeys(pack.signals)
    ]
    return F.array_compact(F.array(*hits))


def _entity_hits(pack: EnrichPack) -> Column:
    return F.array_compact(F.array(*[F.when(has_phrase(F.col("_low"), r.phrase), F.struct(F.lit(r.entity_type).alias("entity_type"), F.lit(r.phrase.lower()).alias("normalized_entity"))) for r in dict.fromkeys(pack.entities)]))


def signals(docs: DataFrame, pack: EnrichPack, text: str = "text") -> DataFrame:
    """A row per document and matching signal rule: ``signal_type``, ``matched_pattern``, ``topic_hint``, ``signal_score``,
    ``evidence_text``. Rules that need a topic count only where there is one."""
    rows = once(docs, _low=F.lower(F.col(text)))
    rows = once(rows, topic_hint=topic_hint(F.col("_low"), pack))
    exploded = once(rows, _hits=_signal_hits(pack)).withColumn("_hit", F.explode("_hits"))
    return exploded.select(*[c for c in docs.columns if c != text], F.col(text).alias("evidence_text"), "topic_hint", "_hit.signal_type", "_hit.matched_pattern", F.lit(1.0).alias("signal_score"))


def entities(docs: DataFrame, pack: EnrichPack, text: str = "text") -> DataFrame:
    """A row per document, entity type and entity."""
    rows = once(docs, _low=F.lower(F.col(text)))
    exploded = once(rows, _hits=_entity_hits(pack)).withColumn("_hit", F.explode("_hits"))
    return exploded.select(*[c for c in docs.columns if c != text], F.col(text).alias("evidence_text"), "_hit.entity_type", "_hit.normalized_entity")


def mentions(docs: DataFrame, pack: EnrichPack, signal_type: str, text: str = "text") -> DataFrame:
    """Entities and the signals of one type from one pass over the documents: ``result_kind`` (``entity`` or the type),
    ``result_category`` (entity type or topic) and ``result_label`` (entity or pattern)."""
    rows = once(docs, _low=F.lower(F.col(text)))
    rows = once(rows, topic_hint=topic_hint(F.col("_low"), pack))
    found = F.transform(_entity_hits(pack), lambda h: _mention(F.lit("entity"), h["entity_type"], h["normalized_entity"]))
    kind = F.transform(F.filter(_signal_hits(pack), lambda h: h["signal_type"] == signal_type), lambda h: _mention(F.lit(signal_type), F.col("topic_hint"), h["matched_pattern"]))
    exploded = once(rows, _hits=F.concat(found, kind)).withColumn("_hit", F.explode("_hits"))
    return exploded.select(*[c for c in docs.columns if c != text], F.col(text).alias("evidence_text"), "_hit.*")


def _mention(kind: Column, category: Column, label: Column) -> Column:
    return F.struct(kind.alias("result_kind"), F.coalesce(category, F.lit("unclassified")).alias("result_category"), label.alias("result_label"))


def _count_of(values: str, wanted: str) -> Column:
    return F.size(F.filter(values, lambda x: x == wanted))


KINDS = ("pain_point", "feature_request", "recommendation_request", "workaround", "comparison")


def daily(docs: DataFrame, pack: EnrichPack, text: str = "text") -> DataFrame:
    """Figures per day and subreddit of all documents, with the counts of the signals of the usable ones by type.

    Documents are read and tested once; medians and distinct authors come from range-sorted runs, so a day and community
    of any size is spread over tasks. Null days and communities form groups, for which signals are not counted; a null
    author is no author."""
    rows = once(docs, _low=F.when(is_usable(text), F.lower(F.col(text))))
    rows = once(rows, topic_hint=topic_hint(F.col("_low"), pack))
    rows = once(rows, _kinds=F.coalesce(F.transform(_signal_hits(pack), lambda h: h["signal_type"]), F.array().cast("array<string>")))
    keys = ["day", "subreddit"]
    sums = ["submission_count", "comment_count", *[f"{k}_count" for k in KINDS]]
    narrow = rows.select(
        F.to_date("created_at").alias("day"), "subreddit", "score", F.lower("author").alias("_author"), (F.col("source_type") == "submission").alias("submission_count"), (F.col("source_type") == "comment").alias("comment_count"),
        *[_count_of("_kinds", k).alias(f"{k}_count") for k in KINDS],
    )
    narrow = materialize(narrow, "daily")
    scores = run_states(narrow, keys, "score", sums).withColumn("median_score", (F.col("low").cast("double") + F.col("high").cast("double")) / 2)
    authors = run_states(narrow, keys, "_author").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n_distinct").alias("unique_authors"))
    joined = scores.join(authors, F.col("day").eqNullSafe(F.col("_day")) & F.col("subreddit").eqNullSafe(F.col("_subreddit")))
    return joined.select(*keys, "submission_count", "comment_count", "unique_authors", "median_score", *[F.when(F.col("day").isNotNull() & F.col("subreddit").isNotNull(), F.col(f"{k}_count")).otherwise(0).alias(f"{k}_count") for k in KINDS])
