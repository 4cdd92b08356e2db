"""Stratified samples for review, applied annotations, and quality figures with gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.operators.candidates import decisions, score
from skeinwork.operators.ranged import run_positions
from skeinwork.packs import RelevancePack
from skeinwork.scratch import materialize

KEY = ["source_type", "source_id"]


def best_domain(scores: DataFrame) -> DataFrame:
    """The row of each candidate's best domain: highest score, then name; its decision is the candidate's stratum."""
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col("relevance_score").desc_nulls_last(), F.col("domain").asc_nulls_last()))
    return scores.withColumn("_rank", rank).filter("_rank = 1").drop("_rank").withColumn("sample_stratum", F.col("decision"))


def pivot_scores(scores: DataFrame, domains: Sequence[str]) -> DataFrame:
    """One row per candidate with the score of each domain."""
    return scores.groupBy(*KEY).agg(*[F.max(F.when(F.col("domain") == d, F.col("relevance_score"))).alias(f"{d}_score") for d in domains])


def stratified_sample(candidates: DataFrame, seed: str, caps: Mapping[str, int], default: int) -> DataFrame:
    """Per stratum the rows with the smallest seeded hashes, with ``stratum_population`` and ``sample_rank``. A cap of 0 keeps
    all, -1 the default number. Strata may be of any size: ranks come from a range sort, not from a window."""
    hashed = candidates.withColumn("_h", F.md5(F.concat_ws(":", F.col("source_type"), F.col("source_id"), F.lit(seed))))
    placed = run_positions(hashed, ["sample_stratum"], [F.col("_h").asc(), F.col("source_id").asc()]).drop("_h", "prefix")
    sizes = candidates.groupBy("sample_stratum").agg(F.count(F.lit(1)).alias("stratum_population"))
    limit = F.lit(default)
    for stratum, cap in caps.items():
        limit = F.when(F.col("sample_stratum") == stratum, default if cap < 0 else (2**62 if cap == 0 else cap)).otherwise(limit)
    kept = placed.filter(F.col("position") < limit).withColumn("sample_rank", F.col("position") + 1).drop("position")
    return kept.join(F.broadcast(sizes), "sample_stratum")  # one row per decision


STRATA = ("retain", "evaluate", "discard")


def export_sample(candidates: DataFrame, scores: DataFrame, domains: Sequence[str], seed: str, caps: Mapping[str, int], default: int, text: str = "original_text") -> DataFrame:
    """The sheet for review: a stratified sample of ``candidates`` (with ``subreddit``, ``source_url`` and ``text``) with the
    score of each domain, the prediction of the best one, an excerpt and empty labels. The stratum is the best decision
    over all domains. Rows come by stratum (retain, evaluate, discard), then by type and id."""
    best = best_domain(scores).select(*KEY, F.col("domain").alias("predicted_domain"), F.col("relevance_score").alias("predicted_score"), F.col("relevance_tier").alias("predicted_tier"), F.col("decision").alias("predicted_decision"))
    summary = pivot_scores(scores, domains).join(best, KEY).join(decisions(scores).withColumnRenamed("decision", "sample_stratum"), KEY)
    rows = candidates.select(*KEY, "subreddit", F.left(text, F.lit(1000)).alias("text_excerpt"), "source_url").join(summary, KEY)
    drawn = stratified_sample(materialize(rows, "sheet"), seed, caps, default).withColumn("sampling_seed", F.lit(seed))
    blank = [*[f"label_{d}" for d in domains], "false_positive_category", "label_notes"]
    place = F.lit(len(STRATA))
    for i, stratum in enumerate(STRATA):
        place = F.when(F.col("sample_stratum") == stratum, i).otherwise(place)
    return drawn.withColumns({c: F.lit(None).cast("string") for c in blank}).orderBy(place, *KEY)


def fixture_faults(labels: DataFrame, scores: DataFrame, domains: Sequence[str]) -> DataFrame:
    """``fault`` and ``n``: what a set of labels claims and the scores do not bear out. ``labels`` has the key, the columns of
    a drawn sample as text and a label for each domain; all counts are 0 for one that may be evaluated.

    Strata and their populations are derived from the scores: the claimed stratum, population, strata without a label,
    and the retained candidates, all of which have to be labelled, are held against them."""
    if missing := {*KEY, "sample_stratum", "stratum_population", "sample_rank", "sampling_seed", *[f"label_{d}" for d in domains]} - set(labels.columns):
        raise ValueError(f"labels without the columns {sorted(missing)}")
    derived = materialize(decisions(scores).withColumnRenamed("decision", "stratum"), "strata")
    sizes = derived.groupBy("stratum").agg(F.count(F.lit(1)).alias("population"))
    marked = labels.join(derived, KEY, "left").join(F.broadcast(sizes.select(F.col("stratum").alias("sample_stratum"), "population")), "sample_stratum", "left")  # one row per decision
    claimed = F.expr("try_cast(stratum_population AS BIGINT)")
    key = F.concat_ws(":", *KEY)
    counts = marked.agg(
        (F.count(F.lit(1)) == 0).cast("long").alias("no_labels"), (F.count(F.lit(1)) - F.countDistinct(key)).alias("repeated_ids"),
        *[F.count_if(~F.coalesce(F.col(f"label_{d}").isin("0", "1"), F.lit(False))).alias(f"invalid_label_{d}") for d in domains],
        F.count_if(F.col("stratum").isNull()).alias("unknown_ids"), F.count_if(F.col("sample_stratum") != F.col("stratum")).alias("other_stratum"),
        F.count_if(claimed.isNull()).alias("population_no_number"), F.count_if(claimed != F.col("population")).alias("other_population"),
        F.count_if((F.col("sample_stratum") == "retain") & F.col("stratum").isNull()).alias("unknown_retained"), F.count_if(F.col("sample_stratum") == "retain").alias("_claimed"),
    )
    kept = derived.filter("stratum = 'retain'")
    unlabelled = kept.join(labels, KEY, "left_anti").agg(F.count(F.lit(1)).alias("retained_without_label"))
    without = sizes.join(labels.select(F.col("sample_stratum").alias("stratum")), "stratum", "left_anti").agg(F.count(F.lit(1)).alias("strata_without_label"))
    expected = labels.select(*KEY, F.explode(F.array(*[F.lit(d) for d in domains])).alias("domain"))
    seen = scores.groupBy(*KEY, "domain").agg(F.count(F.lit(1)).alias("_n"))
    uneven = expected.join(seen, [*KEY, "domain"], "left").agg(F.count_if(F.coalesce("_n", F.lit(0)) != 1).alias("not_one_score"))
    one = counts.crossJoin(kept.agg(F.count(F.lit(1)).alias("_kept"))).crossJoin(unlabelled).crossJoin(without).crossJoin(uneven)  # one row each
    one = one.withColumn("retained_difference", F.abs(F.col("_claimed") - F.col("_kept"))).drop("_claimed", "_kept")
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("fault"), F.col(c).cast("long").alias("n")) for c in one.columns])).alias("f")).select("f.*")


def require_fixture(labels: DataFrame, scores: DataFrame, domains: Sequence[str]) -> None:
    """An error that names every fault, if there is one."""
    if found := {r["fault"]: r["n"] for r in fixture_faults(labels, scores, domains).filter("n > 0").collect()}:
        raise ValueError(f"the labels do not fit the scores: {found}")


def calibrate(candidates: DataFrame, pack: RelevancePack, positives: Mapping[str, Sequence[str]], categories: Mapping[str, Sequence[str]], seed: str, gate: Gate, text: str = "candidate_text") -> dict[str, object]:
    """One fixture through all stages: candidates are scored by ``pack``, all of them are drawn, the reviewed ids are applied
    as labels, and the figures are held against the gate. Reviewed ids that are no candidates are an error."""
    domains = [d.name for d in pack.domains]
    scores = materialize(score(candidates, pack), "scores")
    sheet = export_sample(candidates, scores, domains, seed, dict.fromkeys(STRATA, 0), 0, text)
    labels = materialize(annotate(sheet, {d: positives.get(d, ()) for d in domains}, categories), "labels")
    require_fixture(labels, scores, domains)
    figures = overall(labels, scores, domains)
    return {"pack": pack.version, "figures": figures, "domains": [r.asDict() for r in domain_quality(labels, scores, domains).orderBy("domain").collect()], "failures": gate.failures(figures)}


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def domain_quality(labels: DataFrame, scores: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Per domain: true and false positives, positives, precision, recall and F1 of the decision ``retain``.
    ``labels`` has ``source_id`` and a column ``label_<domain>`` with ``0`` or ``1``; a null label is left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("domain"), F.col(f"label_{d}").alias("label")) for d in domains]))
    long = labels.select("source_id", pairs.alias("p")).select("source_id", "p.domain", "p.label").filter("label IS NOT NULL")
    retained = scores.groupBy("source_id", "domain").agg(F.bool_or(F.col("decision") == "retain").alias("retained"))
    joined = long.join(retained, ["source_id", "domain"])
    counts = joined.groupBy("domain").agg(
        F.count_if((F.col("label") == "1") & F.col("retained")).alias("true_positives"), F.count_if((F.col("label") == "0") & F.col("retained")).alias("false_positives"), F.count_if(F.col("label") == "1").alias("positives")
    )
    rated = counts.withColumns({"precision": ratio(F.col("true_positives"), F.col("true_positives") + F.col("false_positives")), "recall": ratio(F.col("true_positives"), F.col("positives"))})
    return rated.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def weighted_recall(sampled: DataFrame) -> DataFrame:
    """Positives of the population estimated from a stratified sample: ``sample_stratum, stratum_population, label``."""
    strata = sampled.groupBy("sample_stratum").agg(F.max("stratum_population").alias("population"), F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("label") == "1").alias("positive"))
    strata = strata.withColumn("estimated", F.col("population") * F.col("positive") / F.col("sampled"))
    total = strata.agg(F.sum("estimated").alias("estimated_positives"), F.sum(F.when(F.col("sample_stratum") == "retain", F.col("estimated"))).alias("retained_positives"))
    return total.select("estimated_positives", F.coalesce("retained_positives", F.lit(0.0)).alias("retained_positives"), ratio(F.col("retained_positives"), F.col("estimated_positives")).alias("weighted_recall"))


def orphans(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """Labelled ids without any score."""
    return labels.select("source_id").distinct().join(scores.select("source_id"), "source_id", "left_anti")


def cardinality(labels: DataFrame, scores: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Label and domain pairs that do not have exactly one score."""
    expected = labels.select("source_id").distinct().withColumn("domain", F.explode(F.array(*[F.lit(d) for d in domains])))
    seen = scores.groupBy("source_id", "domain").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(seen, ["source_id", "domain"], "left").select("source_id", "domain", F.coalesce("n", F.lit(0)).alias("n_scores")).filter("n_scores <> 1")


def annotate(sample: DataFrame, positives: Mapping[str, Sequence[str]], categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Labels from reviewed ids: ``label_<domain>`` is ``1`` for listed ids and ``0`` for others, and the category of a false
    positive. Duplicate or unknown ids, an id in two categories and a categorised positive are errors."""
    listed = [i for ids in positives.values() for i in ids]
    sorted_out = [i for ids in categories.values() for i in ids]
    for domain, ids in [*positives.items(), *categories.items()]:
        if len(set(ids)) != len(ids):
            raise ValueError(f"{domain}: an id occurs twice")
    if len(set(sorted_out)) != len(sorted_out):
        raise ValueError("an id is in two categories")
    if both := set(listed) & set(sorted_out):
        raise ValueError(f"positive and in a category: {sorted(both)[:5]}")
    spark = sample.sparkSession
    named = spark.createDataFrame([(i,) for i in {*listed, *sorted_out}], "source_id string")
    unknown = [r[0] for r in named.join(sample.select("source_id"), "source_id", "left_anti").limit(5).collect()]
    if unknown:
        raise ValueError(f"unknown ids: {unknown}")
    out = sample
    for domain, ids in positives.items():
        marks = spark.createDataFrame([(i, "1") for i in ids], f"source_id string, label_{domain} string")
        out = out.drop(f"label_{domain}").join(F.broadcast(marks), "source_id", "left").fillna("0", [f"label_{domain}"])
    kinds = spark.createDataFrame([(i, c) for c, ids in categories.items() for i in ids], "source_id string, false_positive_category string")
    return out.drop("false_positive_category").join(F.broadcast(kinds), "source_id", "left")


@dataclass(frozen=True)
class Gate:
    precision: float = 0.70
    recall: float = 0.60
    f1: float = 0.60
    retained: int = 10
    leakage: float = 0.20

    def failures(self, figures: Mapping[str, float]) -> list[str]:
        """What a set of figures lacks; empty if the gate is passed."""
        low = [name for name in ("precision", "recall", "f1", "retained") if figures[name] < getattr(self, name)]
        return low + (["leakage"] if figures["leakage"] > self.leakage else [])


def overall(labels: DataFrame, scores: DataFrame, domains: Sequence[str]) -> dict[str, float]:
    """Figures over candidates: positive if any label is, retained if any domain is; leakage is the share of rows with a
    false-positive category that are retained."""
    any_label = F.greatest(F.lit("0"), *[F.coalesce(F.col(f"label_{d}"), F.lit("0")) for d in domains]) == "1"
    kept = scores.groupBy("source_id").agg(F.bool_or(F.col("decision") == "retain").alias("kept"))
    rows = labels.select("source_id", any_label.alias("positive"), "false_positive_category").join(kept, "source_id")
    trap = F.col("false_positive_category").isNotNull() & (F.col("false_positive_category") != "")
    r = rows.agg(F.count_if("kept").alias("retained"), F.count_if(F.col("kept") & F.col("positive")).alias("tp"), F.count_if("positive").alias("pos"), F.count_if(trap).alias("traps"), F.count_if(trap & F.col("kept")).alias("leaks")).first()
    precision, recall = r["tp"] / r["retained"] if r["retained"] else 0.0, r["tp"] / r["pos"] if r["pos"] else 0.0
    return {"precision": precision, "recall": recall, "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0, "retained": r["retained"], "leakage": r["leaks"] / r["traps"] if r["traps"] else 0.0}
