"""Queries over the raw, clean and mart layers, the query layer and the candidates, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.text import near, once, tokens
from skeinwork.operators import candidates, cleaning, enrich, marts
from skeinwork.packs import FORUM_CANDIDATES, FORUM_ENRICH, FORUM_RELEVANCE, DomainRules
from skeinwork.plans import layers, query_layer
from skeinwork.plans.common import table
from skeinwork.plans.layers import CLEAN_SQL, ENRICH_SQL, RAW_SQL, quoted
from skeinwork.plans.query_layer import QuerySpec

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _both(c: DataFrame, s: DataFrame) -> DataFrame:
    return c.withColumn("record_type", F.lit("comments")).unionByName(s.withColumn("record_type", F.lit("submissions")), allowMissingColumns=True)


def _missing(column: str):
    return F.count_if(F.col(column).isNull() | (F.col(column) == "")).alias(f"missing_{column}")


@query(f"WITH {RAW_SQL} SELECT 'comments' AS record_type, count(*) AS row_count FROM raw_comments UNION ALL SELECT 'submissions', count(*) FROM raw_submissions")
def raw_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return _both(layers.raw_comments(spark, d), layers.raw_submissions(spark, d)).groupBy("record_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"""WITH {RAW_SQL}, both_kinds AS (SELECT 'comments' AS record_type, source_file, manifest_id, ingested_at FROM raw_comments UNION ALL SELECT 'submissions', source_file, manifest_id, ingested_at FROM raw_submissions)
SELECT record_type, count(*) FILTER (WHERE source_file IS NULL OR source_file = '') AS missing_source_file, count(*) FILTER (WHERE manifest_id IS NULL OR manifest_id = '') AS missing_manifest_id,
  count(*) FILTER (WHERE ingested_at IS NULL OR ingested_at = '') AS missing_ingested_at FROM both_kinds GROUP BY 1""")
def provenance_nulls(spark: SparkSession, d: str) -> DataFrame:
    return _both(layers.raw_comments(spark, d), layers.raw_submissions(spark, d)).groupBy("record_type").agg(_missing("source_file"), _missing("manifest_id"), _missing("ingested_at"))


@query(f"WITH {RAW_SQL} SELECT 'comments' AS record_type, count(DISTINCT lower(subreddit)) AS distinct_subreddits FROM raw_comments UNION ALL SELECT 'submissions', count(DISTINCT lower(subreddit)) FROM raw_submissions")
def distinct_sources(spark: SparkSession, d: str) -> DataFrame:
    return _both(layers.raw_comments(spark, d), layers.raw_submissions(spark, d)).groupBy("record_type").agg(F.countDistinct(F.lower("subreddit")).alias("distinct_subreddits"))


@query("SELECT year, month, count(*) AS row_count FROM source_documents WHERE year = 2021 AND month IN ('01', '03') AND lower(subreddit) IN ('tinysaas', 'fareclub') GROUP BY 1, 2")
def preflight_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_documents").filter((F.col("year") == 2021) & F.col("month").isin("01", "03") & F.lower("subreddit").isin("tinysaas", "fareclub"))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"WITH {CLEAN_SQL} SELECT id, body_clean, is_deleted, is_removed, is_bot_like, text_length, raw_duplicate_count, score FROM clean_comments")
def clean_comments(spark: SparkSession, d: str) -> DataFrame:
    return layers.comments(spark, d).select("id", "body_clean", "is_deleted", "is_removed", "is_bot_like", "text_length", "raw_duplicate_count", "score")


@query(f"WITH {CLEAN_SQL} SELECT id, title_clean, combined_text, is_deleted, is_removed, is_bot_like, text_length, raw_duplicate_count FROM clean_submissions")
def clean_submissions(spark: SparkSession, d: str) -> DataFrame:
    return layers.submissions(spark, d).select("id", "title_clean", "combined_text", "is_deleted", "is_removed", "is_bot_like", "text_length", "raw_duplicate_count")


@query(f"""WITH {CLEAN_SQL} SELECT source_type, round(avg(CAST(is_deleted AS DOUBLE)), 9) AS deleted_ratio, round(avg(CAST(is_removed AS DOUBLE)), 9) AS removed_ratio, round(avg(CAST(is_bot_like AS DOUBLE)), 9) AS bot_like_ratio,
  count(*) FILTER (WHERE text_length = 0 AND NOT is_deleted AND NOT is_removed) AS unexpected_empty_text, count(*) FILTER (WHERE created_at IS NULL) AS invalid_created_at FROM docs GROUP BY 1""")
def clean_quality(spark: SparkSession, d: str) -> DataFrame:
    ratios = [F.round(F.avg(F.col(c).cast("double")), 9).alias(n) for c, n in (("is_deleted", "deleted_ratio"), ("is_removed", "removed_ratio"), ("is_bot_like", "bot_like_ratio"))]
    empty = F.count_if((F.col("text_length") == 0) & ~F.col("is_deleted") & ~F.col("is_removed")).alias("unexpected_empty_text")
    return layers.docs(spark, d).groupBy("source_type").agg(*ratios, empty, F.count_if(F.col("created_at").isNull()).alias("invalid_created_at"))


@query(f"WITH {RAW_SQL} SELECT count(*) AS duplicate_id_groups, CAST(sum(n) AS BIGINT) AS rows_in_groups FROM (SELECT id, count(*) AS n FROM raw_comments GROUP BY id HAVING count(*) > 1)")
def duplicate_id_groups(spark: SparkSession, d: str) -> DataFrame:
    groups = layers.raw_comments(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.agg(F.count(F.lit(1)).alias("duplicate_id_groups"), F.sum("n").alias("rows_in_groups"))


@query(f"WITH {ENRICH_SQL} SELECT source_type, source_id, subreddit, created_at, topic_hint, signal_type, matched_pattern FROM signals")
def signals_regex_join(spark: SparkSession, d: str) -> DataFrame:
    return layers.signals(spark, d).select("source_type", "source_id", "subreddit", "created_at", "topic_hint", "signal_type", "matched_pattern")


@query(f"WITH {ENRICH_SQL} SELECT source_type, source_id, subreddit, created_at, entity_type, normalized_entity FROM entities")
def entities_regex_join(spark: SparkSession, d: str) -> DataFrame:
    return layers.entities(spark, d).select("source_type", "source_id", "subreddit", "created_at", "entity_type", "normalized_entity")


_KINDS = ("pain_point", "feature_request", "recommendation_request", "workaround", "comparison")


@query(f"""WITH {ENRICH_SQL},
base AS (SELECT CAST(created_at AS DATE) AS d, subreddit AS sub, count(*) FILTER (WHERE source_type = 'submission') AS submission_count, count(*) FILTER (WHERE source_type = 'comment') AS comment_count,
  count(DISTINCT lower(author)) AS unique_authors, median(score) AS median_score FROM docs GROUP BY 1, 2),
counts AS (SELECT CAST(created_at AS DATE) AS d, subreddit AS sub, {", ".join(f"count(*) FILTER (WHERE signal_type = '{k}') AS {k}_count" for k in _KINDS)} FROM signals GROUP BY 1, 2)
SELECT b.d AS day, b.sub AS subreddit, submission_count, comment_count, unique_authors, median_score, {", ".join(f"coalesce({k}_count, 0) AS {k}_count" for k in _KINDS)}
FROM base b LEFT JOIN counts c ON b.d = c.d AND b.sub = c.sub""")
def metrics_daily(spark: SparkSession, d: str) -> DataFrame:
    return enrich.daily(layers.docs(spark, d), FORUM_ENRICH)


def _views(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "research_signals": layers.signals(spark, d),
        "entity_mentions": layers.entities(spark, d),
        "subreddit_metrics_daily": table(spark, d, "subreddit_metrics_daily"),
        "source_documents": table(spark, d, "source_documents"),
    }


@query(f"""WITH {ENRICH_SQL} SELECT signal_type, coalesce(topic_hint, 'unclassified') AS topic_hint, matched_pattern, count(*) AS signal_count, count(DISTINCT subreddit) AS subreddit_count, min(created_at) AS first_seen_at, max(created_at) AS last_seen_at
FROM signals GROUP BY 1, 2, 3 ORDER BY signal_count DESC, subreddit_count DESC, signal_type, topic_hint, matched_pattern LIMIT 50""")
def signal_summary(spark: SparkSession, d: str) -> DataFrame:
    return query_layer.run(_views(spark, d), QuerySpec("signal_summary"))


@query(f"""WITH {ENRICH_SQL}, sources AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY clean_run_id DESC) AS rn FROM source_documents) WHERE rn = 1),
top AS (SELECT * FROM signals WHERE signal_type = 'workaround' AND lower(evidence_text) LIKE '%spreadsheet%' ORDER BY created_at DESC NULLS LAST, source_id, signal_type, matched_pattern LIMIT 50)
SELECT t.signal_type, coalesce(t.topic_hint, 'unclassified') AS topic_hint, t.matched_pattern, t.subreddit, t.source_type, t.source_id, t.created_at, s.score, t.evidence_text[:500] AS evidence_text, s.source_url, t.source_file, t.manifest_id
FROM top t LEFT JOIN sources s ON t.source_type = s.source_type AND t.source_id = s.source_id""")
def signal_evidence(spark: SparkSession, d: str) -> DataFrame:
    views = _views(spark, d)
    rows = table(spark, d, "source_documents")
    newest = rows.groupBy("source_type", "source_id").agg(F.max(F.struct("clean_run_id", "score", "source_url")).alias("r"))
    views["source_documents"] = newest.select("source_type", "source_id", "r.score", "r.source_url")
    return query_layer.run(views, QuerySpec("signal_evidence", {"signal_type": " Workaround "}, "Spreadsheet"))


@query(f"""WITH {ENRICH_SQL} SELECT entity_type, normalized_entity, count(*) AS mention_count, count(DISTINCT subreddit) AS subreddit_count, min(created_at) AS first_seen_at, max(created_at) AS last_seen_at
FROM entities WHERE source_type = 'comment' GROUP BY 1, 2 ORDER BY mention_count DESC, subreddit_count DESC, entity_type, normalized_entity LIMIT 10""")
def entity_summary(spark: SparkSession, d: str) -> DataFrame:
    return query_layer.run(_views(spark, d), QuerySpec("entity_summary", {"source_type": "comment"}, limit=10))


@query("""SELECT day, subreddit, submission_count, comment_count, unique_authors, median_score, pain_point_count, feature_request_count, recommendation_request_count, workaround_count, comparison_count,
  round(CAST(pain_point_count + feature_request_count + recommendation_request_count + workaround_count + comparison_count AS DOUBLE) / nullif(comment_count + submission_count, 0), 4) AS signal_density
FROM subreddit_metrics_daily WHERE lower(subreddit) = 'tinysaas' ORDER BY day DESC, subreddit, submission_count, comment_count, unique_authors, median_score LIMIT 1000""")
def subreddit_metrics(spark: SparkSession, d: str) -> DataFrame:
    return query_layer.run({"subreddit_metrics_daily": table(spark, d, "subreddit_metrics_daily")}, QuerySpec("subreddit_metrics", {"subreddit": "TinySaaS"}, limit=1000))


@query(f"""SELECT source_type, source_id, subreddit, created_at, score, analytical_text[:500] AS analytical_text, source_url, clean_run_id, source_file, manifest_id
FROM source_documents WHERE trim(analytical_text) <> '' AND lower(analytical_text) LIKE '%refund%'
ORDER BY CASE WHEN regexp_matches(lower(analytical_text), '{query_layer.PAIN_CONTEXT}') THEN 1 ELSE 0 END DESC, CASE WHEN regexp_matches(lower(analytical_text), '{query_layer.PAYMENT_CONTEXT}') THEN 1 ELSE 0 END,
  score DESC NULLS LAST, created_at DESC NULLS LAST, source_id, clean_run_id LIMIT 100""")
def source_search(spark: SparkSession, d: str) -> DataFrame:
    return query_layer.run({"source_documents": table(spark, d, "source_documents")}, QuerySpec("source_search", contains="refund", limit=100))


@query(f"WITH {ENRICH_SQL} SELECT subreddit, count(*) AS pain_points FROM signals WHERE signal_type = 'pain_point' GROUP BY 1 ORDER BY pain_points DESC, subreddit LIMIT 25")
def custom_sql_pain_points(spark: SparkSession, d: str) -> DataFrame:
    text = "SELECT subreddit, count(*) AS pain_points FROM research_signals WHERE signal_type = 'pain_point' GROUP BY 1 ORDER BY pain_points DESC, subreddit NULLS LAST"
    return query_layer.run(_views(spark, d), QuerySpec("custom_sql", sql=text, limit=25))


def _mart_sql(kinds: tuple[str, ...], by: list[str]) -> str:
    cols, where = ", ".join(by), ", ".join(f"'{k}'" for k in kinds)
    on = " AND ".join("coalesce(c.topic_hint, '') = coalesce(e.topic_hint, '')" if b == "topic_hint" else f"c.{b} = e.{b}" for b in by)
    return f"""WITH {ENRICH_SQL}, chosen AS (SELECT * FROM signals WHERE signal_type IN ({where})), counts AS (SELECT {cols}, count(*) AS signal_count FROM chosen GROUP BY ALL),
ranked AS (SELECT {cols}, source_type, source_id, created_at, evidence_text[:300] AS evidence_snippet, row_number() OVER (PARTITION BY {cols} ORDER BY created_at DESC NULLS LAST, source_id) AS rank FROM chosen)
SELECT {", ".join(f"c.{b}" for b in by)}, c.signal_count, e.source_type, e.source_id, e.created_at, e.evidence_snippet FROM counts c LEFT JOIN ranked e ON {on} AND e.rank = 1
ORDER BY c.signal_count DESC, {", ".join(f"c.{b} NULLS LAST" for b in by)} LIMIT 50"""


@query(_mart_sql(("pain_point",), ["subreddit", "topic_hint", "matched_pattern"]))
def mart_pain_points(spark: SparkSession, d: str) -> DataFrame:
    return marts.pain_points(layers.signals(spark, d))


@query(_mart_sql(("feature_request", "recommendation_request", "workaround"), ["subreddit", "signal_type", "topic_hint", "matched_pattern"]))
def mart_app_ideas(spark: SparkSession, d: str) -> DataFrame:
    return marts.app_ideas(layers.signals(spark, d))


def _ranked_sql(kind: str, source: str, category: str, label: str, most: int) -> str:
    return f"""(SELECT '{kind}' AS result_kind, c.result_category, c.result_label, c.result_count, e.source_type, e.source_id, e.subreddit, e.created_at, e.evidence_snippet
FROM (SELECT {category} AS result_category, {label} AS result_label, count(*) AS result_count FROM {source} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT {most}) c
LEFT JOIN (SELECT {category} AS result_category, {label} AS result_label, source_type, source_id, subreddit, created_at, evidence_text[:300] AS evidence_snippet,
  row_number() OVER (PARTITION BY {category}, {label} ORDER BY created_at DESC NULLS LAST, source_id) AS rank FROM {source}) e
ON c.result_category = e.result_category AND c.result_label = e.result_label AND e.rank = 1)"""


@query(f"""WITH {ENRICH_SQL}, workarounds AS (SELECT * FROM signals WHERE signal_type = 'workaround')
{_ranked_sql("entity", "entities", "entity_type", "normalized_entity", 20)} UNION ALL {_ranked_sql("workaround", "workarounds", "coalesce(topic_hint, 'unclassified')", "matched_pattern", 10)}""")
def mart_entity_workaround(spark: SparkSession, d: str) -> DataFrame:
    found = enrich.mentions(cleaning.usable(layers.docs(spark, d), "text"), FORUM_ENRICH, "workaround")
    return marts.entities_and_workarounds(found, {"entity": 20, "workaround": 10})


@query(f"""WITH {ENRICH_SQL}, chosen AS (SELECT *, coalesce(topic_hint, 'unclassified') AS topic FROM signals WHERE signal_type = 'feature_request'),
top AS (SELECT signal_type, topic, matched_pattern, count(*) AS signal_count FROM chosen GROUP BY 1, 2, 3 ORDER BY signal_count DESC, count(DISTINCT subreddit) DESC, 1, 2, 3 LIMIT 5),
ranked AS (SELECT c.*, t.signal_count, row_number() OVER (PARTITION BY c.signal_type, c.topic, c.matched_pattern ORDER BY created_at DESC NULLS LAST, source_id) AS evidence_rank
  FROM chosen c JOIN top t ON c.signal_type = t.signal_type AND c.topic = t.topic AND c.matched_pattern = t.matched_pattern)
SELECT signal_type, topic, matched_pattern, signal_count, CAST(evidence_rank AS INTEGER) AS evidence_rank, source_type, source_id, subreddit, created_at, evidence_text[:500] AS evidence_text FROM ranked WHERE evidence_rank <= 3""")
def evidence_topk_groups(spark: SparkSession, d: str) -> DataFrame:
    return marts.evidence_groups(layers.signals(spark, d), "feature_request", 5, 3)[1]


# candidates and scores

def _term_sql(low: str, term: str) -> str:
    return f"regexp_matches({low}, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')" if term.isalnum() else f"contains({low}, {quoted(term)})"


_P = FORUM_CANDIDATES
_FOUND = ", ".join(f"list_filter([{', '.join(f'CASE WHEN {_term_sql('m', t)} THEN {quoted(t)} END' for t in terms)}], lambda x: x IS NOT NULL) AS found_{g}" for g, terms in _P.groups.items())
_GROUPS = f"list_filter([{', '.join(f'CASE WHEN len(found_{g}) > 0 THEN {quoted(g)} END' for g in _P.groups)}], lambda x: x IS NOT NULL)"
CANDIDATE_SQL = f"""{CLEAN_SQL},
prepared AS (SELECT *, trim(regexp_replace(coalesce(text, ''), '{layers.SPACE}', ' ', 'g')) AS candidate_text FROM docs),
eligible AS (SELECT *, lower(trim(regexp_replace(candidate_text, 'https?://[^ \\t\\n\\f\\r]+', ' ', 'g'))) AS m, coalesce(lower(subreddit), '') IN ({", ".join(map(quoted, _P.priors))}) AS subreddit_prior_match,
  {layers._bot("author", "trim(candidate_text)", candidates.BOT_STARTS)} AS bot FROM prepared
  WHERE length(candidate_text) >= {_P.minimum_length} AND lower(trim(text)) NOT IN ({", ".join(map(quoted, _P.excluded))})),
found AS (SELECT *, {_FOUND} FROM eligible),
grouped AS (SELECT *, {_GROUPS} AS matched_rule_groups, flatten([{", ".join(f"found_{g}" for g in _P.groups)}]) AS matched_terms FROM found),
candidates AS (SELECT * FROM grouped WHERE subreddit_prior_match OR len(matched_rule_groups) > 0)"""


def _scan(spark: SparkSession, d: str) -> DataFrame:
    return candidates.scan(layers.docs(spark, d), FORUM_CANDIDATES)


@query(f"WITH {CANDIDATE_SQL} SELECT source_type, source_id, subreddit_prior_match, bot AS is_bot_like, array_to_string(matched_rule_groups, ',') AS groups, array_to_string(matched_terms, ',') AS terms FROM candidates")
def candidate_scan(spark: SparkSession, d: str) -> DataFrame:
    return _scan(spark, d).select("source_type", "source_id", "subreddit_prior_match", "is_bot_like", F.array_join("matched_rule_groups", ",").alias("groups"), F.array_join("matched_terms", ",").alias("terms"))


@query(f"""WITH {CANDIDATE_SQL}, one AS (SELECT count(*) AS rows_candidates, count(*) FILTER (WHERE subreddit_prior_match AND len(matched_rule_groups) = 0) AS prior_only,
  {", ".join(f"count(*) FILTER (WHERE list_contains(matched_rule_groups, '{g}')) AS g_{g}" for g in _P.groups)}, (SELECT count(*) FROM docs) AS rows_seen FROM candidates)
SELECT 'rows_candidates' AS measure, rows_candidates AS value FROM one UNION ALL SELECT 'prior_only', prior_only FROM one UNION ALL SELECT 'rows_seen', rows_seen FROM one UNION ALL SELECT 'rejected_early', rows_seen - rows_candidates FROM one
{" ".join(f"UNION ALL SELECT 'group:{g}', g_{g} FROM one" for g in _P.groups)}""")
def candidate_group_yield(spark: SparkSession, d: str) -> DataFrame:
    documents = layers.docs(spark, d)
    return candidates.scan_counts(documents, candidates.scan(documents, FORUM_CANDIDATES), FORUM_CANDIDATES)


def _near_sql(p) -> str:
    def at(term: str) -> str:
        words = term.split()
        test = " AND ".join(f"words[i + {k + 1}] = {quoted(w)}" for k, w in enumerate(words))
        return f"list_filter(range(len(words)), lambda i: {test})"

    a, b = (f"flatten([{', '.join(at(t) for t in terms)}])" for terms in (p.anchors, p.evidence))
    return f"len(list_filter({a}, lambda x: len(list_filter({b}, lambda y: abs(x - y) <= {p.window})) > 0)) > 0"


def _points_sql(d: DomainRules) -> tuple[str, str]:
    def p(test: str, w: float) -> str:
        return f"CASE WHEN {test} THEN {round(w * 100)} ELSE 0 END"

    groups = {g: f"list_contains(matched_rule_groups, '{g}')" for g in d.groups}
    gains = [p(groups[g], w) for g, w in d.groups.items()] + [p(_term_sql("low", t), w) for t, w in d.context.items()] + [p(_near_sql(x), x.weight) for x in d.proximity] + [p("subreddit_prior_match", d.prior_weight)]
    losses = [p(_term_sql("low", t), w) for t, w in d.penalties.items()] or ["0"]
    tests = ["NOT bot"]
    if d.required_terms:
        tests.append(f"list_has_any(matched_terms, [{', '.join(map(quoted, d.required_terms))}])")
    if d.required_groups:
        tests.append(f"list_has_any(matched_rule_groups, [{', '.join(map(quoted, d.required_groups))}])")
    if d.minimum_groups:
        tests.append(f"({' + '.join(f'CASE WHEN {g} THEN 1 ELSE 0 END' for g in groups.values())}) >= {d.minimum_groups}")
    return f"CASE WHEN {' AND '.join(tests)} THEN greatest(0, {' + '.join(gains)} - ({' + '.join(losses)})) ELSE 0 END", f"CASE WHEN {' AND '.join(tests)} AND subreddit_prior_match THEN {round(d.prior_weight * 100)} ELSE 0 END"


SCORE_SQL = f"""{CANDIDATE_SQL},
worded AS (SELECT *, lower(trim(candidate_text)) AS low, regexp_extract_all(lower(trim(candidate_text)), '[a-z0-9]+') AS words FROM candidates),
pointed AS ({" UNION ALL ".join(f"SELECT source_type, source_id, '{d.name}' AS domain, {_points_sql(d)[0]} AS points, {_points_sql(d)[1]} AS prior_points FROM worded" for d in FORUM_RELEVANCE.domains)}),
scored AS (SELECT *, CASE WHEN points >= 80 THEN 'A' WHEN points >= 60 THEN 'B' WHEN points >= 40 THEN 'C' ELSE 'D' END AS relevance_tier,
  CASE WHEN points >= 60 THEN 'retain' WHEN points >= 40 THEN 'evaluate' ELSE 'discard' END AS decision FROM pointed)"""


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return candidates.score(_scan(spark, d), FORUM_RELEVANCE)


@query(f"""WITH {SCORE_SQL} SELECT source_type, source_id, domain, least(100, points) / 100.0::DOUBLE AS relevance_score, prior_points / 100.0::DOUBLE AS subreddit_prior,
  least(100, greatest(0, points - prior_points)) / 100.0::DOUBLE AS signal_prior, relevance_tier, decision FROM scored""")
def score_domains(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).select("source_type", "source_id", "domain", "relevance_score", "subreddit_prior", "signal_prior", "relevance_tier", "decision")


@query(f"""WITH {SCORE_SQL}, best AS (SELECT source_type, source_id, max(CASE decision WHEN 'retain' THEN 3 WHEN 'evaluate' THEN 2 ELSE 1 END) AS r FROM scored GROUP BY 1, 2)
SELECT CASE r WHEN 3 THEN 'retain' WHEN 2 THEN 'evaluate' ELSE 'discard' END AS decision, count(*) AS n FROM best GROUP BY 1""")
def score_decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return candidates.decisions(_scores(spark, d)).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


_LOSS = FORUM_RELEVANCE.domains[0].proximity[0]


@query(f"WITH {CLEAN_SQL}, worded AS (SELECT source_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM docs) SELECT source_id FROM worded WHERE {_near_sql(_LOSS)}")
def proximity_hits(spark: SparkSession, d: str) -> DataFrame:
    rows = once(layers.docs(spark, d), words=tokens(F.lower("text")))
    return once(rows, hit=near(F.col("words"), _LOSS.anchors, _LOSS.evidence, _LOSS.window)).filter("hit").select("source_id")
