"""Scan for candidates with high recall, and their scoring per domain by a rule pack."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.text import collapse, has_term, is_bot, near, once, strip_links, tokens
from skeinwork.packs import CandidatePack, DomainRules, RelevancePack

# fixed values: how texts of bots begin
BOT_STARTS = ("i am a bot", "this action was performed automatically", "sorry .+ your submission has been removed")


def scan(docs: DataFrame, pack: CandidatePack, title: str | None = None, text: str = "text") -> DataFrame:
    """Documents of the minimum length that a rule group or a prior community keeps.

    Adds ``candidate_text`` (title and text, white space collapsed, then trimmed), ``subreddit_prior_match``,
    ``matched_rule_groups``, ``matched_terms`` (in order of the pack; a term of two groups occurs twice) and
    ``candidate_reasons``. Terms are looked for without links, in lower case.
    """
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ([title, text] if title else [text])]
    rows = once(docs, candidate_text=F.trim(collapse(F.concat_ws(" ", *parts))))
    rows = rows.filter((F.length("candidate_text") >= pack.minimum_length) & ~F.lower(F.trim(F.coalesce(F.col(text), F.lit("")))).isin(*pack.excluded))
    rows = once(rows, _match=F.lower(F.trim(strip_links(F.col("candidate_text"))))).withColumns({
        "subreddit_prior_match": F.lower(F.coalesce("subreddit", F.lit(""))).isin(*pack.priors),
        "is_bot_like": is_bot(F.col("author"), F.col("candidate_text"), BOT_STARTS, trimmed=True),
    })
    # one array of terms per group, from which groups and terms follow
    found = {g: F.array_compact(F.array(*[F.when(has_term(F.col("_match"), t), F.lit(t)) for t in terms])) for g, terms in pack.groups.items()}
    rows = once(rows, _found=F.struct(*[expr.alias(g) for g, expr in found.items()]))
    groups = F.array_compact(F.array(*[F.when(F.size(F.col(f"_found.{g}")) > 0, F.lit(g)) for g in pack.groups]))
    rows = once(rows, matched_rule_groups=groups, matched_terms=F.flatten(F.array(*[F.col(f"_found.{g}") for g in pack.groups])))
    rows = rows.filter(F.col("subreddit_prior_match") | (F.size("matched_rule_groups") > 0))
    prior = F.when(F.col("subreddit_prior_match"), F.array(F.lit("subreddit_prior"))).otherwise(F.array().cast("array<string>"))
    return rows.withColumns({"candidate_reasons": F.concat("matched_rule_groups", prior), "candidate_version": F.lit(pack.version)}).drop("_match", "_found")


def scan_counts(docs: DataFrame, candidates: DataFrame, pack: CandidatePack) -> DataFrame:
    """``measure, value``: rows seen, candidates, rejected early, prior only, and candidates per group, in one pass each."""
    groups = [F.count_if(F.array_contains("matched_rule_groups", g)).alias(f"group:{g}") for g in pack.groups]
    only = F.count_if(F.col("subreddit_prior_match") & (F.size("matched_rule_groups") == 0)).alias("prior_only")
    one = candidates.agg(F.count(F.lit(1)).alias("rows_candidates"), only, *groups).crossJoin(docs.agg(F.count(F.lit(1)).alias("rows_seen")))
    one = one.withColumn("rejected_early", F.col("rows_seen") - F.col("rows_candidates"))
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in one.columns]), F.array(*[F.col(f"`{c}`") for c in one.columns]))).alias("measure", "value"))


def _scaled(weight: float, scale: int) -> int:
    return int(Decimal(str(weight)).scaleb(scale))


def _tests(d: DomainRules, low: Column, words: Column) -> Column:
    """What the text is tested for, as a struct of booleans."""
    terms = [has_term(low, t).alias(f"t{i}") for i, t in enumerate([*d.context, *d.penalties])]
    return F.struct(F.lit(d.name).alias("domain"), *terms, *[near(words, p.anchors, p.evidence, p.window).alias(f"p{i}") for i, p in enumerate(d.proximity)])


def _domain(d: DomainRules, tests: str, scale: int) -> Column:
    def points(hit: Column, weight: float) -> Column:
        return F.when(hit, _scaled(weight, scale)).otherwise(0)

    def add(values: list[Column]) -> Column:
        total = F.lit(0)
        for v in values:
            total = total + v
        return total

    group = {g: F.array_contains("matched_rule_groups", g) for g in d.groups}
    context = {t: F.col(f"{tests}.t{i}") for i, t in enumerate(d.context)}
    penalty = {t: F.col(f"{tests}.t{i + len(d.context)}") for i, t in enumerate(d.penalties)}
    close = {p.name: F.col(f"{tests}.p{i}") for i, p in enumerate(d.proximity)}
    prior = F.col("subreddit_prior_match")
    eligible = ~F.col("is_bot_like")
    if d.required_terms:
        eligible = eligible & F.arrays_overlap("matched_terms", F.array(*[F.lit(t) for t in d.required_terms]))
    if d.required_groups:
        eligible = eligible & F.arrays_overlap("matched_rule_groups", F.array(*[F.lit(g) for g in d.required_groups]))
    if d.minimum_groups:
        eligible = eligible & (add([points(h, 1.0) for h in group.values()]) >= d.minimum_groups * 10**scale)
    gains = [*[points(h, d.groups[g]) for g, h in group.items()], *[points(h, d.context[t]) for t, h in context.items()], *[points(close[p.name], p.weight) for p in d.proximity], points(prior, d.prior_weight)]
    losses = [points(h, d.penalties[t]) for t, h in penalty.items()]
    reasons = [*[F.when(group[g], F.lit(g)) for g in sorted(group)], *[F.when(context[t], F.lit(f"context:{t}")) for t in sorted(context)], *[F.when(penalty[t], F.lit(f"penalty:{t}")) for t in sorted(penalty)], *[F.when(close[n], F.lit(f"proximity:{n}")) for n in sorted(close)], F.when(prior, F.lit("subreddit_prior"))]
    raw = F.when(F.coalesce(eligible, F.lit(False)), F.greatest(F.lit(0), add(gains) - add(losses))).otherwise(0)
    own_prior = F.when(F.coalesce(eligible, F.lit(False)) & prior, _scaled(d.prior_weight, scale)).otherwise(0)
    return F.struct(F.lit(d.name).alias("domain"), raw.cast("long").alias("points"), own_prior.cast("long").alias("prior_points"), F.array_compact(F.array(*reasons)).alias("decision_reasons"))


def score(candidates: DataFrame, pack: RelevancePack) -> DataFrame:
    """A row per candidate and domain, from one scan: ``relevance_score``, ``subreddit_prior``, ``signal_prior``, tier and
    decision. Weights are added as integers of their smallest decimal, so sums are exact at the limits of the tiers."""
    weights = [w for d in pack.domains for w in [d.prior_weight, *d.groups.values(), *d.context.values(), *d.penalties.values(), *[p.weight for p in d.proximity]]]
    scale = max(2, *[-Decimal(str(w)).as_tuple().exponent for w in [*weights, *pack.tiers]])
    unit = float(10**scale)
    rows = once(once(candidates, _low=F.lower(F.trim(F.col("candidate_text")))), _words=tokens(F.col("_low")))
    rows = once(rows, **{f"_t{i}": _tests(d, F.col("_low"), F.col("_words")) for i, d in enumerate(pack.domains)})
    rows = rows.withColumn("_d", F.explode(F.array(*[_domain(d, f"_t{i}", scale) for i, d in enumerate(pack.domains)])))
    points = F.col("_d.points")
    limits = [_scaled(t, scale) for t in pack.tiers]
    capped = F.least(F.lit(10**scale), points)
    tier = F.when(capped >= limits[0], "A").when(capped >= limits[1], "B").when(capped >= limits[2], "C").otherwise("D")
    decision = F.when(capped >= limits[1], "retain").when(capped >= limits[2], "evaluate").otherwise("discard")
    clamped = F.least(F.lit(10**scale), F.greatest(F.lit(0), points - F.col("_d.prior_points")))
    return rows.select(
        "source_type", "source_id", F.col("_d.domain").alias("domain"), (capped / unit).alias("relevance_score"), (F.col("_d.prior_points") / unit).alias("subreddit_prior"),
        (clamped / unit).alias("signal_prior"), "matched_terms", "matched_rule_groups", F.col("_d.decision_reasons").alias("decision_reasons"), tier.alias("relevance_tier"), decision.alias("decision"), F.lit(pack.version).alias("relevance_version"),
    )


def decisions(scores: DataFrame) -> DataFrame:
    """The best decision of each candidate over its domains."""
    rank = F.max(F.when(F.col("decision") == "retain", 3).when(F.col("decision") == "evaluate", 2).otherwise(1)).alias("_rank")
    return scores.groupBy("source_type", "source_id").agg(rank).select("source_type", "source_id", F.when(F.col("_rank") == 3, "retain").when(F.col("_rank") == 2, "evaluate").otherwise("discard").alias("decision"))
