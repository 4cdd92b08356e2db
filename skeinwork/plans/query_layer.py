"""The query layer: named queries with filters, and guarded custom SQL, over curated views."""

from __future__ import annotations

import datetime
import decimal
import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: what a search result is ranked by
PAIN_CONTEXT = "(difficult|frustrat|annoy|struggle|problem|issue|reject|refus|delay|paperwork|process|embassy|consulate|appointment|residenc|permit)"
PAYMENT_CONTEXT = "(^|[^a-z])(card|credit|forex|lounge|amex|mastercard|scotiabank)([^a-z]|$)"
VIEWS = ("research_signals", "entity_mentions", "subreddit_metrics_daily", "source_documents")


@dataclass(frozen=True)
class QuerySpec:
    name: str
    filters: dict[str, str] = field(default_factory=dict)
    contains: str = ""
    limit: int = 50
    sql: str = ""


def wanted(value: str | None) -> str:
    """A filter value in the form it is compared in; ``*`` stands for no filter."""
    return (value or "").strip().lower() or "*"


def _equal(df: DataFrame, spec: QuerySpec, columns: dict[str, str]) -> DataFrame:
    for name, column in columns.items():
        value = wanted(spec.filters.get(name))
        if value != "*":
            col = F.coalesce(F.col(column), F.lit("")) if column == "topic_hint" else F.col(column)
            df = df.filter(F.lower(col) == value)
    return df


def like(column: str, term: str) -> Column:
    """``%term%`` without case, in which ``%`` and ``_`` of the term are wildcards and a backslash is itself."""
    text = "%" + term.strip().lower().replace("\\", "\\\\") + "%"
    return F.lower(F.col(column)).like(text)


def signal_summary(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    rows = _signals(views, spec).withColumn("topic_hint", F.coalesce("topic_hint", F.lit("unclassified")))
    by = ["signal_type", "topic_hint", "matched_pattern"]
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("signal_count"), F.countDistinct("subreddit").alias("subreddit_count"), F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at"))
    return out.orderBy(F.desc("signal_count"), F.desc("subreddit_count"), *by).limit(max(spec.limit, 1))


def _signals(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    rows = _equal(views["research_signals"], spec, {c: c for c in ("signal_type", "topic_hint", "subreddit", "source_type", "matched_pattern")})
    return rows.filter(like("evidence_text", spec.contains)) if spec.contains.strip() else rows


def signal_evidence(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    rows = _signals(views, spec).withColumn("topic_hint", F.coalesce("topic_hint", F.lit("unclassified"))).drop("score")
    # the rows to show are chosen first, so that the join is one of few rows
    top = rows.orderBy(F.col("created_at").desc_nulls_last(), "source_id", "signal_type", "matched_pattern").limit(max(spec.limit, 1))
    sources = views["source_documents"].select("source_type", "source_id", "score", "source_url")
    return top.join(sources, ["source_type", "source_id"], "left").select(
        "signal_type", "topic_hint", "matched_pattern", "subreddit", "source_type", "source_id", "created_at", "score", F.left("evidence_text", F.lit(500)).alias("evidence_text"), "source_url", "source_file", "manifest_id"
    )


def entity_summary(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    rows = _equal(views["entity_mentions"], spec, {"entity_type": "entity_type", "entity_text": "normalized_entity", "subreddit": "subreddit", "source_type": "source_type"})
    by = ["entity_type", "normalized_entity"]
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("mention_count"), F.countDistinct("subreddit").alias("subreddit_count"), F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at"))
    return out.orderBy(F.desc("mention_count"), F.desc("subreddit_count"), *by).limit(max(spec.limit, 1))


def subreddit_metrics(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    kinds = ["pain_point_count", "feature_request_count", "recommendation_request_count", "workaround_count", "comparison_count"]
    total = sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))
    density = F.round(total.cast("double") / F.nullif(F.col("comment_count") + F.col("submission_count"), F.lit(0)), 4)
    rows = _equal(views["subreddit_metrics_daily"], spec, {"subreddit": "subreddit"})
    figures = ["submission_count", "comment_count", "unique_authors", "median_score", *kinds]
    return rows.select("day", "subreddit", *figures, density.alias("signal_density")).orderBy(F.desc("day"), F.col("subreddit").asc_nulls_last(), *figures).limit(max(spec.limit, 1))


def source_search(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    rows = views["source_documents"].filter(F.col("analytical_text").isNotNull() & (F.trim("analytical_text") != ""))
    rows = _equal(rows, spec, {"subreddit": "subreddit", "source_type": "source_type"})
    if spec.contains.strip():
        rows = rows.filter(like("analytical_text", spec.contains))
    low = F.lower("analytical_text")
    ranked = rows.orderBy(low.rlike(PAIN_CONTEXT).cast("int").desc(), low.rlike(PAYMENT_CONTEXT).cast("int").asc(), F.col("score").desc_nulls_last(), F.col("created_at").desc_nulls_last(), F.col("source_id"), F.col("clean_run_id"))
    return ranked.limit(max(spec.limit, 1)).select("source_type", "source_id", "subreddit", "created_at", "score", F.left("analytical_text", F.lit(500)).alias("analytical_text"), "source_url", "clean_run_id", "source_file", "manifest_id")


class UnsafeQuery(ValueError):
    """The SQL text is not a single read of the curated views."""


#: what a plain read is made of, by the parser's names
NODES = set("Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct Join LateralJoin SubqueryAlias UnresolvedSubqueryColumnAliases Union Except Intersect UnresolvedHaving WithWindowDefinition OneRowRelation UnresolvedInlineTable UnresolvedWith UnresolvedRelation".split())
#: functions of values, groups and windows; none that reads files, settings or the machine
FUNCTIONS = set("""
abs and array array_agg array_contains array_distinct array_join array_max array_min array_size avg between bool_and bool_or btrim cardinality ceil ceiling
char_length coalesce collect_list collect_set concat concat_ws contains corr count count_if date date_add date_diff date_format date_sub date_trunc datediff
day dayofmonth dayofweek dense_rank element_at endswith every exp explode filter first first_value flatten floor from_json from_unixtime get_json_object
greatest hour if ifnull ilike in initcap instr isnotnull isnull json_array_length lag last last_value lcase lead least left length like levenshtein listagg ln locate
log log10 lower lpad ltrim max max_by md5 mean median min min_by minute mod mode month months_between nanvl not ntile nullif nvl nvl2 or percent_rank percentile
percentile_approx position pow power quarter rank regexp_count regexp_extract regexp_extract_all regexp_like regexp_replace regexp_substr repeat replace
reverse right rlike round row_number rpad rtrim second sha2 sign size slice some sort_array split sqrt startswith stddev string_agg substr substring sum
to_date to_timestamp transform trim trunc try_divide ucase unix_timestamp upper variance weekofyear when year
""".split())


def _read_only(spark: SparkSession, plan: Any, scope: frozenset[str]) -> None:
    """Walks a parsed plan: every part has to be known, every relation a view or a table expression in scope there."""
    def seq(items: Any) -> list[Any]:
        return [items.apply(i) for i in range(items.size())]

    def expression(e: Any) -> None:
        kind = e.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            name = e.nameParts().mkString(".").lower()
            if name not in FUNCTIONS:
                raise UnsafeQuery(f"{name} is no function of the query layer")
        if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
            _read_only(spark, e.plan(), scope)
        for child in seq(e.children()):
            expression(child)

    kind = plan.getClass().getSimpleName()
    if kind not in NODES:
        raise UnsafeQuery(f"not a plain query: {kind}")
    if kind == "UnresolvedRelation":
        name = plan.multipartIdentifier().mkString(".").lower()
        if name not in scope and name not in VIEWS:
            raise UnsafeQuery(f"{name} is no curated view")
    for e in seq(plan.expressions()):
        expression(e)
    if kind == "UnresolvedWith":
        # a table expression is known to those after it and to the query, not outside
        for own in seq(plan.cteRelations()):
            _read_only(spark, own._2(), scope)
            scope = scope | {own._1().lower()}
    for child in seq(plan.children()):
        _read_only(spark, child, scope)


def check_sql(spark: SparkSession, text: str) -> str:
    """The statement without its end mark. It must parse as one query of known parts and functions, whose relations are
    curated views or table expressions in scope; files, calls into the machine, commands and writes are refused."""
    statement = text.strip().rstrip(";").strip()
    if not re.match(r"(?i)^(select|with)\b", statement):
        raise UnsafeQuery("a query begins with SELECT or WITH")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except Exception as error:
        raise UnsafeQuery(f"not one statement: {str(error).splitlines()[0]}") from None
    _read_only(spark, plan, frozenset())
    return statement


def custom_sql(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    df = next(iter(views.values()))
    spark = df.sparkSession
    statement = check_sql(spark, spec.sql)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM ({statement}) LIMIT {max(spec.limit, 1)}")


REGISTRY: dict[str, Callable[[dict[str, DataFrame], QuerySpec], DataFrame]] = {
    "signal_summary": signal_summary,
    "signal_evidence": signal_evidence,
    "entity_summary": entity_summary,
    "subreddit_metrics": subreddit_metrics,
    "source_search": source_search,
    "custom_sql": custom_sql,
}


def run(views: dict[str, DataFrame], spec: QuerySpec) -> DataFrame:
    if spec.name not in REGISTRY:
        raise KeyError(f"no query {spec.name!r}; there are {', '.join(REGISTRY)}")
    return REGISTRY[spec.name](views, spec)


def _plain(value: Any) -> Any:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def to_payload(df: DataFrame, spec: QuerySpec, path: str | None = None) -> dict[str, Any]:
    """The result, already limited by the query, as a plain structure, written to ``path`` as JSON if given."""
    rows = [{k: _plain(v) for k, v in row.asDict().items()} for row in df.toLocalIterator()]
    payload = {"status": "completed", "query_name": spec.name, "row_count": len(rows), "columns": df.columns, "rows": rows, "output_path": path}
    if path:
        with open(path, "w") as out:
            json.dump(payload, out, indent=2, ensure_ascii=False)
    return payload
