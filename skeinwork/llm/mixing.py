"""Mixing sources to target weights.

The records of each source are put in a salted random order and cut into blocks of equally many tokens. Slot ``i`` of
the mixture belongs to the source in whose stretch of the cumulative weights the point ``frac(i * golden ratio)`` lies,
so that every stretch of the schedule is close to the weights; slots are ranked per source and joined with the blocks.
After its last block a source starts again, as often as it may.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.joining import attach
from skeinwork.llm.sampling import salted_hash
from skeinwork.operators.ranged import run_positions
from skeinwork.scratch import materialize

#: the golden ratio's inverse, and the fraction of its multiple by 2 ** 20, so that large slot numbers lose no digits
GOLDEN = 0.6180339887498949
GOLDEN_20 = float(math.fmod(Fraction(math.isqrt(5 << 200), 1 << 100) * (1 << 19) - (1 << 19), 1))


def _point(slot: Column) -> Column:
    """The fraction of ``slot`` times the golden ratio."""
    whole = F.shiftright(slot, 20) * F.lit(GOLDEN_20) + slot.bitwiseAND((1 << 20) - 1) * F.lit(GOLDEN)
    return whole - F.floor(whole)


@dataclass
class Mixture:
    picks: DataFrame
    report: DataFrame


def mix(
    docs: DataFrame, weights: DataFrame, identifier: str, source: str, tokens: str, total: int | None = None, block: int = 1024, salt: str = "mix"
) -> Mixture:
    """A mixture of ``docs[identifier, source, tokens]`` by ``weights[source, target_share, max_repeats]``.

    ``picks`` has ``identifier, source, copy, slot, tokens``: a document occurs with ``copy`` 0, 1, ... below its
    source's ``max_repeats``. ``report`` has a row per listed source: target and actual share, tokens, documents and
    the most copies. ``total`` is the size in tokens; by default the largest for which all sources that have
    documents reach their share. A slot is a block of ``block`` tokens, whatever the total: a mixture of any size is mixed as
    finely. A smaller source than its share of a given ``total`` gives all it may.

    Shares are counted among the listed sources that have documents. Documents without tokens and those of unlisted or
    null sources are left out; a repeated row of ``weights`` counts once; a share or a repeat count that is null or not
    positive leaves a source out. The table of weights has one row per source; it is joined by a size that is checked.
    """
    listed = weights.select(F.col("source").alias("_s"), F.col("target_share").cast("double").alias("_w"), F.col("max_repeats").cast("long").alias("_r")).distinct()
    usable = listed.filter("_s IS NOT NULL AND _w > 0 AND _r > 0")
    n_listed = usable.count()
    rows = docs.select(F.col(identifier), F.col(source).alias("_s"), F.col(tokens).cast("long").alias("_t")).filter("_t > 0 AND _s IS NOT NULL")
    rows = attach(rows, usable.select("_s"), ["_s"], identifier, n_listed).withColumn("_h", salted_hash(identifier, salt))
    placed = materialize(run_positions(rows, ["_s"], [F.col("_h").asc(), F.col(identifier).asc()], "_t").drop("position", "_h"), "mix")
    have = materialize(placed.groupBy("_s").agg(F.sum("_t").alias("_have"), F.max("_t").alias("_big")).join(usable, "_s"), "have")
    share_sum = have.agg(F.sum("_w")).first()[0] or 1.0
    if total is None:
        total = have.agg(F.min(F.col("_have") * F.col("_r") / (F.col("_w") / share_sum))).first()[0] or 0
    total = int(total)
    many = -(-total // block) if total else 0
    # stretches of the cumulative weights, in order of name: one row per source that is listed and has documents
    order = Window.orderBy("_s")
    stretches = materialize(have.select(
        "_s", (F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, 0)) / share_sum).alias("_to"),
        F.coalesce(F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, -1)) / share_sum, F.lit(0.0)).alias("_from"),
        (F.row_number().over(order) == F.count(F.lit(1)).over(Window.partitionBy())).alias("_last"),
    ), "stretches")
    # points and stretches meet in bins of the unit interval, so a slot is held against the few sources of its bin
    bins = max(1024, 4 * n_listed)
    last_bin = F.when(F.col("_last"), bins - 1).otherwise(F.least(F.floor(F.col("_to") * bins), F.lit(bins - 1)))
    binned = stretches.withColumn("_bin", F.explode(F.sequence(F.least(F.floor(F.col("_from") * bins), F.lit(bins - 1)), last_bin)))
    drawn = docs.sparkSession.range(many).select(F.col("id").alias("_slot"), _point(F.col("id")).alias("_u"))
    drawn = drawn.withColumn("_bin", F.least(F.floor(F.col("_u") * bins), F.lit(bins - 1)))
    drawn = attach(drawn, binned, ["_bin"], "_slot", bins + n_listed).filter((F.col("_u") >= F.col("_from")) & ((F.col("_u") < F.col("_to")) | F.col("_last"))).select("_s", "_slot")
    drawn = materialize(drawn, "slots")
    ranked = materialize(run_positions(drawn, ["_s"], [F.col("_slot").asc()]).select("_s", "_slot", F.col("position").alias("_rank")), "ranks")
    # the stream of a source: its documents in order, pass after pass, as many passes as its slots ask for; a document is
    # in the block in which it begins
    asked = ranked.groupBy("_s").agg((F.max("_rank") + 1).alias("_slots"))
    needed = have.join(asked, "_s").select("_s", "_have", F.least(F.col("_r"), F.ceil(F.col("_slots") * block / F.col("_have"))).alias("_passes"))
    passes = attach(placed, needed, ["_s"], identifier, n_listed).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_passes") - 1)))
    passes = passes.withColumn("_rank", F.floor((F.col("copy") * F.col("_have") + F.col("prefix")) / block))
    picks = passes.join(ranked, ["_s", "_rank"]).select(identifier, F.col("_s").alias(source), F.col("copy").cast("int").alias("copy"), F.col("_slot").alias("slot"), F.col("_t").alias(tokens))
    picks = materialize(picks, "picks")
    per = picks.groupBy(source).agg(F.sum(tokens).alias("tokens"), F.countDistinct(identifier).alias("documents"), (F.max("copy") + 1).cast("int").alias("most_copies"))
    reached = per.agg(F.sum("tokens")).first()[0] or 1
    named = listed.groupBy(F.col("_s").alias(source)).agg(F.max("_w").alias("target_share"), F.max("_r").cast("int").alias("max_repeats"))
    report = named.join(per, source, "left").select(
        source, "target_share", F.round(F.coalesce(F.col("tokens"), F.lit(0)) / F.lit(reached), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )
    return Mixture(picks, report)
