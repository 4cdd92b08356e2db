"""The layers of the forum corpus as DataFrames, and the same as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.text import phrase_regex
from skeinwork.operators import cleaning, enrich
from skeinwork.packs import FORUM_ENRICH, EnrichPack
from skeinwork.plans.common import table

SPACE = "[ \\t\\n\\f\\r]+"
# fixed values, stated here once more so that the SQL does not lean on the operators
BOT_STARTS = ("i am a bot", "this action was performed automatically", "beep boop")


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "source_documents").filter("source_type = 'comment'")
    return rows.select(F.col("source_id").alias("id"), "author", "subreddit", F.col("analytical_text").alias("body"), "score", "created_at", "link_id", "parent_id", "source_file", "manifest_id", F.col("clean_run_id").alias("ingested_at"), "month", "year")


def raw_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "source_documents").filter("source_type = 'submission'")
    return rows.select(F.col("source_id").alias("id"), "author", "subreddit", F.col("title_clean").alias("title"), F.col("analytical_text").alias("selftext"), "score", "created_at", "source_file", "manifest_id", F.col("clean_run_id").alias("ingested_at"), "month", "year")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_comments(raw_comments(spark, sf_dir))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_submissions(raw_submissions(spark, sf_dir))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.documents(comments(spark, sf_dir), submissions(spark, sf_dir))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.signals(cleaning.usable(docs(spark, sf_dir), "text"), FORUM_ENRICH)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.entities(cleaning.usable(docs(spark, sf_dir), "text"), FORUM_ENRICH)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bot(author: str, text: str, starts: tuple[str, ...]) -> str:
    return f"(coalesce(lower({author}) = 'automoderator' OR regexp_matches(lower({author}), '(^|[^a-z])bot([^a-z]|$)'), false) OR coalesce(regexp_matches(lower({text}), '^({'|'.join(starts)})'), false))"


def _gone(text: str, mark: str) -> str:
    return f"coalesce(lower(trim({text})) = '[{mark}]', false)"


def _newest(raw: str) -> str:
    return f"(SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS raw_duplicate_count, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST, source_file ASC NULLS LAST) AS rn FROM {raw}) WHERE rn = 1)"


def _hint(pack: EnrichPack) -> str:
    cases = []
    for kind in dict.fromkeys(e.entity_type for e in pack.entities):
        tests = " OR ".join(f"regexp_matches(lower(text), {quoted(phrase_regex(e.phrase))})" for e in pack.entities if e.entity_type == kind)
        cases.append(f"WHEN {tests} THEN '{kind}'")
    return f"CASE {' '.join(cases)} END"


def _rules(pack: EnrichPack) -> tuple[str, str]:
    s = ", ".join(f"({quoted(r.signal_type)}, {quoted(r.phrase)}, {quoted(phrase_regex(r.phrase))}, {str(r.needs_topic).lower()})" for r in pack.signals)
    e = ", ".join(f"({quoted(r.entity_type)}, {quoted(r.phrase)}, {quoted(phrase_regex(r.phrase))})" for r in pack.entities)
    return s, e


RAW_SQL = """
raw_comments AS (
  SELECT source_id AS id, author, subreddit, analytical_text AS body, score, created_at, link_id, parent_id, source_file, manifest_id, clean_run_id AS ingested_at, month, year
  FROM source_documents WHERE source_type = 'comment'
),
raw_submissions AS (
  SELECT source_id AS id, author, subreddit, title_clean AS title, analytical_text AS selftext, score, created_at, source_file, manifest_id, clean_run_id AS ingested_at, month, year
  FROM source_documents WHERE source_type = 'submission'
)"""

CLEAN_SQL = f"""{RAW_SQL},
clean_comments AS (
  SELECT *, length(body_clean) AS text_length FROM (
    SELECT *, regexp_replace(trim(coalesce(body, '')), '{SPACE}', ' ', 'g') AS body_clean, {_gone("body", "deleted")} AS is_deleted, {_gone("body", "removed")} AS is_removed,
      {_bot("author", "body", BOT_STARTS)} AS is_bot_like FROM {_newest("raw_comments")})
),
clean_submissions AS (
  SELECT *, length(combined_text) AS text_length FROM (
    SELECT *, CASE WHEN selftext_clean = '' THEN title_clean WHEN title_clean = '' THEN selftext_clean ELSE title_clean || chr(10) || chr(10) || selftext_clean END AS combined_text FROM (
      SELECT *, regexp_replace(trim(coalesce(title, '')), '{SPACE}', ' ', 'g') AS title_clean, regexp_replace(trim(coalesce(selftext, '')), '{SPACE}', ' ', 'g') AS selftext_clean,
        {_gone("title", "deleted")} OR {_gone("selftext", "deleted")} AS is_deleted, {_gone("title", "removed")} OR {_gone("selftext", "removed")} AS is_removed,
        {_bot("author", "coalesce(title, '') || ' ' || coalesce(selftext, '')", BOT_STARTS)} AS is_bot_like FROM {_newest("raw_submissions")}))
),
docs AS (
  SELECT 'comment' AS source_type, id AS source_id, body_clean AS text, link_id, parent_id, author, subreddit, score, created_at, source_file, manifest_id, text_length, is_deleted, is_removed, is_bot_like FROM clean_comments
  UNION ALL
  SELECT 'submission', id, combined_text, NULL, NULL, author, subreddit, score, created_at, source_file, manifest_id, text_length, is_deleted, is_removed, is_bot_like FROM clean_submissions
)"""

_S, _E = _rules(FORUM_ENRICH)

ENRICH_SQL = f"""{CLEAN_SQL},
usable AS (SELECT * FROM docs WHERE NOT is_deleted AND NOT is_removed AND NOT is_bot_like AND text_length > 0 AND trim(text) <> ''),
hinted AS (SELECT *, {_hint(FORUM_ENRICH)} AS topic_hint FROM usable),
signals AS (
  SELECT DISTINCT h.*, h.text AS evidence_text, r.signal_type, r.matched_pattern
  FROM hinted h JOIN (VALUES {_S}) r(signal_type, matched_pattern, rx, needs_topic) ON regexp_matches(lower(h.text), r.rx)
  WHERE NOT r.needs_topic OR h.topic_hint IS NOT NULL
),
entities AS (
  SELECT DISTINCT u.*, u.text AS evidence_text, r.entity_type, r.normalized_entity
  FROM usable u JOIN (VALUES {_E}) r(entity_type, normalized_entity, rx) ON regexp_matches(lower(u.text), r.rx)
)"""
