"""Queries of evaluation and of the durable store's inputs over the stored scores, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import evaluation as ev
from skeinwork.plans.common import REVIEW, table

QUERIES, SQL = {}, {}
DOMAINS = ("travel", "saas_opportunity", "app_opportunity")
MAPPING = {"travel_terms": "pain_point", "saas_terms": "workflow_fragmentation", "app_terms": "feature_request"}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def scores(spark: SparkSession, d: str) -> DataFrame:
    """The latest scoring of each candidate and domain."""
    columns = ["relevance_score", "relevance_tier", "decision", "relevance_version", "matched_terms", "matched_rules"]
    rows = table(spark, d, "scores").filter("source_id IS NOT NULL")
    newest = rows.groupBy("source_type", "source_id", "domain").agg(F.max(F.struct("scored_at", *columns)).alias("r"))
    return newest.select("source_type", "source_id", "domain", *[f"r.{c}" for c in columns])


def labels(spark: SparkSession, d: str) -> DataFrame:
    """One row per reviewed id; of different labels the greatest counts."""
    return table(spark, d, REVIEW).groupBy("source_id").agg(*[F.max(f"label_{x}").alias(f"label_{x}") for x in DOMAINS], F.max("false_positive_category").alias("false_positive_category"))


_S = """scored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_type, source_id, domain ORDER BY scored_at DESC) AS rn FROM scores WHERE source_id IS NOT NULL) WHERE rn = 1)"""
_L = f"labels AS (SELECT source_id, {', '.join(f'max(label_{x}) AS label_{x}' for x in DOMAINS)}, max(false_positive_category) AS false_positive_category FROM {REVIEW} GROUP BY 1)"
_B = f"{_S}, best AS (SELECT *, decision AS sample_stratum FROM (SELECT *, row_number() OVER (PARTITION BY source_type, source_id ORDER BY relevance_score DESC NULLS LAST, domain) AS place FROM scored) WHERE place = 1)"


@query(f"WITH {_B} SELECT sample_stratum, count(*) AS population, round(avg(relevance_score), 6) AS mean_score FROM best GROUP BY 1")
def eval_strata(spark: SparkSession, d: str) -> DataFrame:
    return ev.best_domain(scores(spark, d)).groupBy("sample_stratum").agg(F.count(F.lit(1)).alias("population"), F.round(F.avg("relevance_score"), 6).alias("mean_score"))


@query(f"""WITH {_B}, placed AS (SELECT source_id, sample_stratum, row_number() OVER (PARTITION BY sample_stratum ORDER BY md5(source_type || ':' || source_id || ':seed-1'), source_id) AS sample_rank,
  count(*) OVER (PARTITION BY sample_stratum) AS stratum_population FROM best)
SELECT * FROM placed WHERE sample_rank <= CASE WHEN sample_stratum = 'retain' THEN 1000000000 ELSE 25 END AND sample_stratum IS NOT NULL""")
def eval_sample_md5(spark: SparkSession, d: str) -> DataFrame:
    best = ev.best_domain(scores(spark, d)).filter("sample_stratum IS NOT NULL")
    return ev.stratified_sample(best, "seed-1", {"retain": 0, "discard": -1}, 25).select("source_id", "sample_stratum", "sample_rank", "stratum_population")


@query(f"WITH {_S} SELECT source_type, source_id, {', '.join(f"max(relevance_score) FILTER (WHERE domain = '{x}') AS {x}_score" for x in DOMAINS)} FROM scored GROUP BY 1, 2")
def eval_domain_pivot(spark: SparkSession, d: str) -> DataFrame:
    return ev.pivot_scores(scores(spark, d), DOMAINS)


@query(f"""WITH {_S}, {_L}, long AS ({" UNION ALL ".join(f"SELECT source_id, '{x}' AS domain, label_{x} AS label FROM labels WHERE label_{x} IS NOT NULL" for x in DOMAINS)}),
kept AS (SELECT source_id, domain, bool_or(decision = 'retain') AS retained FROM scored GROUP BY 1, 2),
c AS (SELECT l.domain, count(*) FILTER (WHERE label = '1' AND retained) AS true_positives, count(*) FILTER (WHERE label = '0' AND retained) AS false_positives, count(*) FILTER (WHERE label = '1') AS positives
  FROM long l JOIN kept k ON l.source_id = k.source_id AND l.domain = k.domain GROUP BY 1),
r AS (SELECT *, coalesce(true_positives / nullif(true_positives + false_positives, 0)::DOUBLE, 0) AS precision, coalesce(true_positives / nullif(positives, 0)::DOUBLE, 0) AS recall FROM c)
SELECT domain, true_positives, false_positives, positives, round(precision, 9) AS precision, round(recall, 9) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 9) AS f1 FROM r""")
def eval_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    out = ev.domain_quality(labels(spark, d), scores(spark, d), DOMAINS)
    return out.select("domain", "true_positives", "false_positives", "positives", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""WITH {_B}, {_L}, pop AS (SELECT sample_stratum, count(*) AS population FROM best GROUP BY 1),
s AS (SELECT b.sample_stratum, count(*) AS sampled, count(*) FILTER (WHERE label_travel = '1') AS positive FROM best b JOIN labels l ON b.source_id = l.source_id WHERE label_travel IS NOT NULL GROUP BY 1),
e AS (SELECT s.sample_stratum, population * positive / sampled::DOUBLE AS estimated FROM s JOIN pop p ON s.sample_stratum = p.sample_stratum)
SELECT round(sum(estimated), 6) AS estimated_positives, round(coalesce(sum(estimated) FILTER (WHERE sample_stratum = 'retain'), 0), 6) AS retained_positives,
  round(coalesce(sum(estimated) FILTER (WHERE sample_stratum = 'retain') / nullif(sum(estimated), 0), 0), 6) AS weighted_recall FROM e""")
def eval_weighted_recall(spark: SparkSession, d: str) -> DataFrame:
    best = ev.best_domain(scores(spark, d))
    sizes = best.groupBy("sample_stratum").agg(F.count(F.lit(1)).alias("stratum_population"))
    sampled = best.join(labels(spark, d), "source_id").filter("label_travel IS NOT NULL").withColumn("label", F.col("label_travel")).join(F.broadcast(sizes), "sample_stratum")
    return ev.weighted_recall(sampled).select(*[F.round(c, 6).alias(c) for c in ("estimated_positives", "retained_positives", "weighted_recall")])


@query(f"SELECT DISTINCT source_id FROM {REVIEW} r WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.source_id = r.source_id)")
def eval_orphans(spark: SparkSession, d: str) -> DataFrame:
    return ev.orphans(table(spark, d, REVIEW), table(spark, d, "scores"))


@query(f"""WITH {_L}, expected AS (SELECT source_id, domain FROM labels CROSS JOIN (VALUES {", ".join(f"('{x}')" for x in DOMAINS)}) v(domain)), seen AS (SELECT source_id, domain, count(*) AS n FROM scores GROUP BY 1, 2)
SELECT e.source_id, e.domain, coalesce(n, 0) AS n_scores FROM expected e LEFT JOIN seen s ON e.source_id = s.source_id AND e.domain = s.domain WHERE coalesce(n, 0) <> 1""")
def eval_cardinality(spark: SparkSession, d: str) -> DataFrame:
    return ev.cardinality(table(spark, d, REVIEW), table(spark, d, "scores"), DOMAINS)


@query("""WITH docs AS (SELECT DISTINCT source_type, source_id FROM source_documents) SELECT d.source_type, d.source_id FROM docs d
WHERE EXISTS (SELECT 1 FROM scores s WHERE s.source_type = d.source_type AND s.source_id = d.source_id AND s.decision = 'retain')""")
def retained_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_documents").select(*ev.KEY).distinct().join(table(spark, d, "scores").filter("decision = 'retain'"), ev.KEY, "left_semi")


@query(f"""WITH {_S} SELECT DISTINCT source_type, source_id FROM scored s WHERE decision = 'evaluate'
AND NOT EXISTS (SELECT 1 FROM scored r WHERE r.source_type = s.source_type AND r.source_id = s.source_id AND r.decision = 'retain')""")
def review_tier_only(spark: SparkSession, d: str) -> DataFrame:
    rows = scores(spark, d)
    return rows.filter("decision = 'evaluate'").select(*ev.KEY).distinct().join(rows.filter("decision = 'retain'"), ev.KEY, "left_anti")


@query(f"""WITH {_S}, kept AS (SELECT source_type, source_id, unnest(from_json(matched_rules, '["VARCHAR"]')) AS rule_group FROM scored WHERE decision = 'retain')
SELECT DISTINCT source_type, source_id, signal_type, sha256(source_type || ':' || source_id || ':' || signal_type) AS signal_id
FROM kept JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in MAPPING.items())}) m(rule_group, signal_type) ON kept.rule_group = m.rule_group""")
def commit_signals_explode(spark: SparkSession, d: str) -> DataFrame:
    groups = scores(spark, d).filter("decision = 'retain'").select(*ev.KEY, F.explode(F.from_json("matched_rules", "array<string>")).alias("rule_group"))
    mapping = spark.createDataFrame(list(MAPPING.items()), "rule_group string, signal_type string")
    rows = groups.join(F.broadcast(mapping), "rule_group").select(*ev.KEY, "signal_type").distinct()  # a handful of rules
    return rows.withColumn("signal_id", F.sha2(F.concat_ws(":", *ev.KEY, "signal_type"), 256))


@query(f"""WITH {_S} SELECT DISTINCT source_type, source_id, unnest(from_json(matched_terms, '["VARCHAR"]')) AS normalized_entity FROM scored WHERE decision = 'retain'""")
def commit_entities_unnest(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).filter("decision = 'retain'").select(*ev.KEY, F.explode(F.from_json("matched_terms", "array<string>")).alias("normalized_entity")).distinct()


@query("""WITH ids AS (SELECT DISTINCT source_type || ':' || source_id AS id, substr(sha256(source_type || ':' || source_id), 1, 2) AS part FROM scores WHERE decision = 'retain' AND source_id IS NOT NULL),
parts AS (SELECT part, count(*) AS n, sha256(string_agg(id, ',' ORDER BY id)) AS digest FROM ids GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS documents, sha256(string_agg(digest, ',' ORDER BY part)) AS checksum FROM parts""")
def durable_checksum(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "scores").filter("decision = 'retain' AND source_id IS NOT NULL").select(F.concat_ws(":", *ev.KEY).alias("id")).distinct()
    return batch_checksum(ids)


def batch_checksum(ids: DataFrame) -> DataFrame:
    """``documents`` and a digest of all ids in order, by parts of the id's hash so that no task holds all of them."""
    parts = ids.groupBy(F.substring(F.sha2("id", 256), 1, 2).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("id")), ","), 256).alias("digest"))
    whole = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "digest"))), lambda p: p["digest"]), ","), 256)
    return parts.agg(F.sum("n").alias("documents"), whole.alias("checksum"))


@query("""WITH seen AS (SELECT count(DISTINCT source_id) AS rows_seen FROM source_documents), s AS (SELECT source_id, bool_or(decision = 'retain') AS kept FROM scores WHERE source_id IN (SELECT source_id FROM source_documents) GROUP BY 1),
c AS (SELECT count(*) AS staged, count(*) FILTER (WHERE kept) AS retained FROM s)
SELECT rows_seen, staged, rows_seen - staged AS rejected_early, retained, staged - retained AS rejected_late FROM seen, c""")
def batch_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "source_documents").select("source_id").distinct()
    kept = table(spark, d, "scores").join(ids, "source_id", "left_semi").groupBy("source_id").agg(F.coalesce(F.bool_or(F.col("decision") == "retain"), F.lit(False)).alias("kept"))
    counts = kept.agg(F.count(F.lit(1)).alias("staged"), F.count_if("kept").alias("retained")).crossJoin(ids.agg(F.count(F.lit(1)).alias("rows_seen")))  # one row each
    return counts.select("rows_seen", "staged", (F.col("rows_seen") - F.col("staged")).alias("rejected_early"), "retained", (F.col("staged") - F.col("retained")).alias("rejected_late"))


@query("SELECT count(DISTINCT (source_type, source_id)) AS candidates, count(*) AS score_rows FROM scores")
def row_valued_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scores").agg(F.countDistinct(F.struct(*ev.KEY)).alias("candidates"), F.count(F.lit(1)).alias("score_rows"))


@query("SELECT domain, array_to_string(list_sort(array_agg(DISTINCT relevance_version)), ',') AS versions, count(DISTINCT relevance_version) = 1 AS uniform FROM scores GROUP BY 1")
def version_uniformity(spark: SparkSession, d: str) -> DataFrame:
    versions = F.sort_array(F.collect_set("relevance_version"))
    return table(spark, d, "scores").groupBy("domain").agg(F.array_join(versions, ",").alias("versions"), (F.size(versions) == 1).alias("uniform"))


@query("""SELECT domain, count(*) - count(DISTINCT coalesce(source_type, '') || ':' || coalesce(source_id, '')) AS repeated_rows, count(*) FILTER (WHERE relevance_score IS NULL) AS without_score,
  bool_or(decision = 'retain') AND NOT bool_or(relevance_tier = 'D' AND decision = 'retain') AS plausible FROM scores GROUP BY 1 HAVING bool_or(decision = 'retain')""")
def score_checks(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.coalesce("source_type", F.lit("")), F.lit(":"), F.coalesce("source_id", F.lit("")))
    retained = F.bool_or(F.col("decision") == "retain")
    out = table(spark, d, "scores").groupBy("domain").agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("repeated_rows"), F.count_if(F.col("relevance_score").isNull()).alias("without_score"), (retained & ~F.bool_or((F.col("relevance_tier") == "D") & (F.col("decision") == "retain"))).alias("plausible"), retained.alias("_r"))
    return out.filter("_r").drop("_r")


_D = """strata AS (SELECT source_type, source_id, CASE max(CASE decision WHEN 'retain' THEN 2 WHEN 'evaluate' THEN 1 ELSE 0 END) WHEN 2 THEN 'retain' WHEN 1 THEN 'evaluate' ELSE 'discard' END AS stratum FROM scored GROUP BY 1, 2)"""
_CLAIMS = f"""claims AS (SELECT coalesce(t.source_type, 'comment') AS source_type, r.source_id, r.predicted_decision AS sample_stratum, CAST(count(*) OVER (PARTITION BY r.predicted_decision) AS VARCHAR) AS stratum_population, {", ".join(f"r.label_{x}" for x in DOMAINS)}
  FROM {REVIEW} r LEFT JOIN (SELECT source_id, min(source_type) AS source_type FROM scored GROUP BY 1) t ON r.source_id = t.source_id)"""


@query(f"""WITH {_S}, {_D}, {_CLAIMS}, sizes AS (SELECT stratum, count(*) AS population FROM strata GROUP BY 1),
marked AS (SELECT c.*, s.stratum, z.population FROM claims c LEFT JOIN strata s ON c.source_type = s.source_type AND c.source_id = s.source_id LEFT JOIN sizes z ON c.sample_stratum = z.stratum),
seen AS (SELECT source_type, source_id, domain, count(*) AS n FROM scored GROUP BY 1, 2, 3)
SELECT 'no_labels' AS fault, CAST(count(*) = 0 AS BIGINT) AS n FROM marked
UNION ALL SELECT 'repeated_ids', count(*) - count(DISTINCT source_type || ':' || coalesce(source_id, '')) FROM marked
{" ".join(f"UNION ALL SELECT 'invalid_label_{x}', count(*) FILTER (WHERE label_{x} IS NULL OR label_{x} NOT IN ('0', '1')) FROM marked" for x in DOMAINS)}
UNION ALL SELECT 'unknown_ids', count(*) FILTER (WHERE stratum IS NULL) FROM marked
UNION ALL SELECT 'other_stratum', count(*) FILTER (WHERE sample_stratum <> stratum) FROM marked
UNION ALL SELECT 'population_no_number', count(*) FILTER (WHERE TRY_CAST(stratum_population AS BIGINT) IS NULL) FROM marked
UNION ALL SELECT 'other_population', count(*) FILTER (WHERE CAST(stratum_population AS BIGINT) <> population) FROM marked
UNION ALL SELECT 'unknown_retained', count(*) FILTER (WHERE sample_stratum = 'retain' AND stratum IS NULL) FROM marked
UNION ALL SELECT 'retained_without_label', count(*) FROM strata s WHERE stratum = 'retain' AND NOT EXISTS (SELECT 1 FROM claims c WHERE c.source_type = s.source_type AND c.source_id = s.source_id)
UNION ALL SELECT 'strata_without_label', count(*) FROM sizes z WHERE NOT EXISTS (SELECT 1 FROM claims c WHERE c.sample_stratum = z.stratum)
UNION ALL SELECT 'not_one_score', count(*) FILTER (WHERE coalesce(s.n, 0) <> 1) FROM claims c CROSS JOIN (VALUES {", ".join(f"('{x}')" for x in DOMAINS)}) v(domain) LEFT JOIN seen s ON c.source_type = s.source_type AND c.source_id = s.source_id AND v.domain = s.domain
UNION ALL SELECT 'retained_difference', abs((SELECT count(*) FROM claims WHERE sample_stratum = 'retain') - (SELECT count(*) FROM strata WHERE stratum = 'retain'))""")
def eval_fixture_faults(spark: SparkSession, d: str) -> DataFrame:
    """The review sample as if it were a labelled sample of these scores: what it claims and they do not bear out."""
    rows = scores(spark, d)
    kinds = rows.groupBy("source_id").agg(F.min("source_type").alias("source_type"))
    review = table(spark, d, REVIEW)
    sizes = review.groupBy("predicted_decision").agg(F.count(F.lit(1)).cast("string").alias("stratum_population")).withColumnRenamed("predicted_decision", "sample_stratum")
    claims = review.join(kinds, "source_id", "left").withColumn("source_type", F.coalesce("source_type", F.lit("comment"))).withColumnRenamed("predicted_decision", "sample_stratum")
    claims = claims.join(F.broadcast(sizes), "sample_stratum", "left").withColumns({"sample_rank": F.lit("1"), "sampling_seed": F.lit("seed-1")})  # one row per decision
    return ev.fixture_faults(claims, rows, DOMAINS)


@query(f"""WITH {_B}, {_D}, docs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_type, source_id ORDER BY clean_run_id DESC) AS place FROM source_documents) WHERE place = 1),
piv AS (SELECT source_type, source_id, {", ".join(f"max(relevance_score) FILTER (WHERE domain = '{x}') AS {x}_score" for x in DOMAINS)} FROM scored GROUP BY 1, 2),
rows_ AS (SELECT c.source_type, c.source_id, left(c.analytical_text, 1000) AS text_excerpt, {", ".join(f"{x}_score" for x in DOMAINS)}, b.domain AS predicted_domain, b.relevance_score AS predicted_score, b.relevance_tier AS predicted_tier, b.decision AS predicted_decision, s.stratum AS sample_stratum
  FROM docs c JOIN piv p ON c.source_type = p.source_type AND c.source_id = p.source_id JOIN best b ON c.source_type = b.source_type AND c.source_id = b.source_id JOIN strata s ON c.source_type = s.source_type AND c.source_id = s.source_id),
placed AS (SELECT *, count(*) OVER (PARTITION BY sample_stratum) AS stratum_population, row_number() OVER (PARTITION BY sample_stratum ORDER BY md5(source_type || ':' || source_id || ':seed-1'), source_id) AS sample_rank FROM rows_)
SELECT * FROM placed WHERE sample_rank <= CASE sample_stratum WHEN 'retain' THEN stratum_population ELSE 25 END
ORDER BY CASE sample_stratum WHEN 'retain' THEN 1 WHEN 'evaluate' THEN 2 ELSE 3 END, source_type, source_id""")
def eval_export(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "source_documents").filter("source_id IS NOT NULL").groupBy(*ev.KEY).agg(F.max(F.struct("clean_run_id", "analytical_text", "subreddit", "source_url")).alias("r")).select(*ev.KEY, "r.*")
    sheet = ev.export_sample(docs, scores(spark, d), DOMAINS, "seed-1", {"retain": 0}, 25, "analytical_text")
    return sheet.select(*ev.KEY, "text_excerpt", *[f"{x}_score" for x in DOMAINS], "predicted_domain", "predicted_score", "predicted_tier", "predicted_decision", "sample_stratum", "stratum_population", "sample_rank")
