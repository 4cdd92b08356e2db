"""Top N items within every group by simultaneous bisection.

Each item has an order-preserving code: its score as an ordered 64-bit integer, then its identifier in chunks of seven
bytes, then the identifier's length. All groups narrow the interval that holds their cutoff at the same time: a round
counts the undecided rows above 255 midpoints of each group's interval, accepts those above the midpoint next to the
cutoff and drops those below. Rows of equal code go on with the next chunk. No group is ever sorted or gathered: a
round is a count by group and interval, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.llm.joining import attach
from skeinwork.scratch import materialize, release

CHUNK = 7


@F.pandas_udf(T.LongType())
def ordered_code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Integers in the order of the doubles; -0.0 counts as 0.0."""
    for scores in batches:
        bits = (scores.to_numpy(np.float64) + 0.0).view(np.int64)
        yield pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def _chunk(identifier: str, number: int) -> Column:
    """Bytes ``7 number ..`` of the identifier as an integer, negated so that the smaller identifier comes first."""
    part = F.substring(F.encode(F.col(identifier), "UTF-8"), number * CHUNK + 1, CHUNK)
    return -F.conv(F.rpad(F.hex(part), 2 * CHUNK, "0"), 16, 10).cast("long")


def top_n(df: DataFrame, group: Sequence[str], score: str, identifier: str, n: int) -> DataFrame:
    """``group``, ``identifier`` and ``score`` of the ``n`` rows of highest score in each group, all rows of smaller groups.

    Equal scores fall to the smaller identifier (UTF-8 byte order). Null and NaN scores and null identifiers are left
    out; null group values form groups. A repeated identifier within a group counts once, with its highest score.
    ``n`` below 1 or an empty table gives no rows; further columns of ``df`` are ignored.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(score).cast("double").alias("_s"), F.col(identifier).cast("string").alias("_id"))
    rows = rows.filter(F.col("_s").isNotNull() & ~F.isnan("_s") & F.col("_id").isNotNull())
    if n < 1:
        rows = rows.limit(0)
    rows = rows.groupBy(*keys, "_id").agg(F.max("_s").alias("_s"))
    # equality of keys by a hash of 128 bits, so that null groups join
    both = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    key = F.struct(F.xxhash64(*both).alias("a"), F.xxhash64(F.lit(1), *both).alias("b"))
    undecided = materialize(rows.withColumn("_k", key).withColumn("_c", ordered_code("_s")), "topn")
    intervals = undecided.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).withColumn("_need", F.lit(n).cast("long"))
    intervals = materialize(intervals, "cuts")
    groups = intervals.count()
    sized = materialize(attach(undecided, intervals.select("_k", "_n"), ["_k"], "_id", groups, "_n"), "topn")
    release(undecided)
    chosen = [sized.filter("_n <= %d" % n).select(*keys, "_id", "_s")]
    undecided = sized.filter("_n > %d" % n).drop("_n")
    intervals = intervals.filter("_n > _need")
    level, longest = 0, None
    while active := intervals.count():
        # groups whose rows all have one code go on with the next chunk of the identifier, all others bisect
        shift = F.greatest(F.lit(0), F.ceil(F.log2((F.col("_hi").cast("double") - F.col("_lo").cast("double")) + 1)) - 8).cast("int")
        table = intervals.withColumn("_shift", shift).select("_k", "_n", "_need", "_lo", "_shift")
        binned = attach(undecided, table, ["_k"], "_id", active, "_n")
        binned = binned.withColumn("_b", F.expr("shiftright(_c, _shift) - shiftright(_lo, _shift)"))
        counts = binned.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_m"), F.min("_c").alias("_blo"), F.max("_c").alias("_bhi"), F.first("_need").alias("_need"))
        above = F.coalesce(F.sum("_m").over(Window.partitionBy("_k").orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cuts = counts.withColumn("_above", above).filter("_above < _need AND _above + _m >= _need")
        cuts = materialize(cuts.select("_k", F.col("_b").alias("_cut"), (F.col("_need") - F.col("_above")).alias("_left"), "_m", "_blo", "_bhi"), "cuts")
        decided = materialize(
            attach(binned, cuts.select("_k", "_cut", "_left", "_m"), ["_k"], "_id", active, "_m")
            .filter("_b >= _cut")
            .select(*keys, "_id", "_s", "_k", "_c", (F.expr("_b > _cut OR _m = _left")).alias("_in")),
            "topn",
        )
        chosen.append(decided.filter("_in").select(*keys, "_id", "_s"))
        undecided = decided.filter("NOT _in").drop("_in")
        intervals = cuts.filter("_m > _left").select("_k", F.col("_m").alias("_n"), F.col("_left").alias("_need"), F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"))
        if not intervals.isEmpty() and intervals.filter("_lo < _hi").isEmpty():
            if longest is None:
                longest = undecided.agg(F.max(F.octet_length("_id"))).first()[0]
            code = _chunk("_id", level) if level * CHUNK < longest else -F.octet_length("_id").cast("long")
            level += 1
            undecided = materialize(undecided.withColumn("_c", code), "topn")
            ends = undecided.groupBy("_k").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi"))
            intervals = materialize(intervals.drop("_lo", "_hi").join(ends, "_k"), "cuts")
    out = chosen[0]
    for part in chosen[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], F.col("_id").alias(identifier), F.col("_s").alias(score))
