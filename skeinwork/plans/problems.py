"""Queries of the general data-pipeline problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators.daily import audit_daily, daily_metrics, records_for_metrics
from skeinwork.operators.hierarchy import Hierarchy, descendants, thread_parent
from skeinwork.operators.records import current_rows
from skeinwork.plans.common import table


def _tree(spark: SparkSession, sf_dir: str) -> Hierarchy:
    rows = current_rows(table(spark, sf_dir, "source_documents"), ["parent_id"])
    return Hierarchy(rows.select("source_id", thread_parent("parent_id").alias("parent_id")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tree(spark, sf_dir).cycles.select(F.col("id").alias("source_id"), "cycle_id")


def p1_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _tree(spark, sf_dir).nodes(with_path=True)
    return nodes.select(F.col("id").alias("source_id"), F.col("root").alias("root_id"), "depth", "size", "preorder", F.concat_ws("/", "path").alias("path"))


def p1_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descendants(_tree(spark, sf_dir).nodes()).select(F.col("ancestor").alias("ancestor_id"), F.col("id").alias("source_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = records_for_metrics(table(spark, sf_dir, "source_documents"))
    return audit_daily(records, table(spark, sf_dir, "subreddit_metrics_daily"))


def p3_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_metrics(records_for_metrics(table(spark, sf_dir, "source_documents")))
    return daily.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "subreddit", "submission_count", "comment_count", "unique_authors", "median_score")


_CURRENT = """
current_docs AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY clean_run_id DESC) AS rn FROM source_documents) WHERE rn = 1
)"""

_LINKS = f"""{_CURRENT},
refs AS (
  SELECT source_id AS id, regexp_replace(regexp_replace(parent_id, '^\\s+|\\s+$', '', 'g'), '^[tT][0-9]_', '') AS ref FROM current_docs
),
links AS (SELECT a.id, b.id AS parent FROM refs a LEFT JOIN refs b ON a.ref = b.id)"""

_TREES = f"""{_LINKS},
walk(id, root, depth, path) AS (
  SELECT id, id, 0, id FROM links WHERE parent IS NULL
  UNION ALL
  SELECT l.id, w.root, w.depth + 1, w.path || '/' || l.id FROM links l JOIN walk w ON l.parent = w.id
)"""

_DAILY = f"""{_CURRENT},
daily AS (
  SELECT CAST(created_at AS DATE) AS d, lower(trim(subreddit)) AS sub,
    count(*) FILTER (WHERE source_type = 'submission') AS submission_count,
    count(*) FILTER (WHERE source_type = 'comment') AS comment_count,
    count(DISTINCT CASE WHEN trim(author) <> '' THEN lower(trim(author)) END) AS unique_authors,
    median(score) AS median_score
  FROM current_docs WHERE created_at IS NOT NULL AND trim(subreddit) <> '' GROUP BY 1, 2
)"""

QUERIES = {"p1_found": p1_found, "p1_hierarchy": p1_hierarchy, "p1_descendants": p1_descendants, "p3_found": p3_found, "p3_daily": p3_daily}

SQL = {
    "p1_found": f"""WITH RECURSIVE {_LINKS},
reached(id) AS (SELECT id FROM links WHERE parent IS NULL UNION ALL SELECT l.id FROM links l JOIN reached r ON l.parent = r.id),
endless AS (SELECT * FROM links WHERE id NOT IN (SELECT id FROM reached)),
above(id, anc) AS (SELECT id, parent FROM endless UNION SELECT a.id, e.parent FROM above a JOIN endless e ON a.anc = e.id),
loops AS (SELECT id FROM above WHERE id = anc)
SELECT a.id AS source_id, min(a.anc) AS cycle_id FROM above a JOIN loops l ON a.anc = l.id GROUP BY 1""",
    "p1_hierarchy": f"""WITH RECURSIVE {_TREES},
sizes AS (SELECT anc AS id, count(*) AS size FROM (SELECT unnest(string_split(path, '/')) AS anc FROM walk) GROUP BY 1)
SELECT w.id AS source_id, w.root AS root_id, CAST(w.depth AS BIGINT) AS depth, s.size,
  row_number() OVER (PARTITION BY w.root ORDER BY string_split(w.path, '/')) - 1 AS preorder, w.path
FROM walk w JOIN sizes s ON w.id = s.id""",
    "p1_descendants": f"""WITH RECURSIVE {_TREES}
SELECT anc AS ancestor_id, id AS source_id FROM (SELECT id, unnest(string_split(path, '/')) AS anc FROM walk) WHERE anc <> id""",
    "p3_found": f"""WITH {_DAILY},
stored AS (
  SELECT DISTINCT day, lower(trim(subreddit)) AS sub2, submission_count AS sc, comment_count AS cc, unique_authors AS ua, median_score AS ms
  FROM subreddit_metrics_daily WHERE trim(subreddit) <> ''
)
SELECT DISTINCT strftime(coalesce(d, day), '%Y-%m-%d') AS day, coalesce(sub, sub2) AS subreddit
FROM daily FULL JOIN stored ON d = day AND sub = sub2
WHERE d IS NULL OR day IS NULL OR submission_count <> sc OR comment_count <> cc OR unique_authors <> ua OR median_score IS DISTINCT FROM ms
  OR sc IS NULL OR cc IS NULL OR ua IS NULL""",
    "p3_daily": f"""WITH {_DAILY}
SELECT strftime(d, '%Y-%m-%d') AS day, sub AS subreddit, submission_count, comment_count, unique_authors, median_score FROM daily""",
}
