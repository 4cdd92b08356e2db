import random
import statistics
from collections import defaultdict

from pyspark.sql import functions as F

from skeinwork.operators.ranged import run_positions, run_states


def rows(n=600, seed=1):
    r = random.Random(seed)
    # one key holds half of the rows, and values repeat
    return [(r.choice(["hot"] * 5 + ["a", "b", None, "", "c"]), r.choice([None, *range(6)]), i, r.choice([None, 1, 5])) for i in range(n)]


def test_positions_and_prefixes_of_a_heavy_key(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, v long, i long, w long").repartition(7)
    got = run_positions(df, ["k"], [F.col("v").desc_nulls_last(), F.col("i").asc()], "w", n=5).collect()
    groups = defaultdict(list)
    for k, v, i, w in data:
        groups[k].append((v is None, -(v or 0), i, w or 0))
    want = {}
    for group in groups.values():
        total = 0
        for place, (_, _, i, w) in enumerate(sorted(group)):
            want[i] = (place, total)
            total += w
    assert {r["i"]: (r["position"], r["prefix"]) for r in got} == want


def test_positions_of_nothing_and_of_one_key(spark):
    empty = spark.createDataFrame([], "k string, v long")
    assert run_positions(empty, ["k"], [F.col("v").asc()]).count() == 0
    same = spark.createDataFrame([("x", 1)] * 40, "k string, v long")
    assert sorted(r["position"] for r in run_positions(same, ["k"], [F.col("v").asc()], n=4).collect()) == list(range(40))


def test_states_equal_plain_statistics(spark):
    data = rows(900, 2)
    df = spark.createDataFrame([(k, v, i % 3 == 0) for k, v, i, _ in data], "k string, v long, f boolean").repartition(5)
    got = {r["k"]: r for r in run_states(df, ["k"], "v", ["f"], n=6).collect()}
    groups = defaultdict(list)
    for k, v, i, _ in data:
        groups[k].append((v, i % 3 == 0))
    assert set(got) == set(groups)
    for k, group in groups.items():
        values = sorted(v for v, _ in group if v is not None)
        r = got[k]
        assert (r["n_rows"], r["n_values"], r["n_distinct"], r["f"]) == (len(group), len(values), len(set(values)), sum(f for _, f in group))
        assert (r["low"] + r["high"]) / 2 == statistics.median(values)


def test_states_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    got = {r["k"]: r for r in run_states(df, ["k"], "v", n=3).collect()}
    assert got["a"]["n_values"] == 0 and got["a"]["low"] is None and got["b"]["n_distinct"] == 1
    assert run_states(spark.createDataFrame([], "k string, v string"), ["k"], "v").count() == 0


def test_a_million_ties_are_no_heavier_than_one(spark):
    ties = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 4 > 0, F.lit(1)).alias("v"), (F.col("id") % 2).alias("f"))
    others = spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")).alias("k"), F.col("id").alias("v"), F.lit(1).alias("f"))
    df = ties.withColumn("v", F.col("v").cast("long")).unionByName(others).repartition(6)
    got = {r["k"]: r for r in run_states(df, ["k"], "v", ["f"], n=5).collect()}
    hot = got["hot"]
    assert (hot["n_rows"], hot["n_values"], hot["n_distinct"], hot["f"], hot["low"], hot["high"]) == (1_000_000, 750_000, 1, 500_000, 1, 1)
    assert len(got) == 51 and (got["k7"]["n_rows"], got["k7"]["low"], got["k7"]["high"]) == (60, 1457, 1507)


def test_a_key_over_all_partitions(spark):
    df = spark.range(5000).select(F.lit("a").alias("k"), (F.col("id") % 1000).alias("v"))
    got = run_states(df, ["k"], "v", n=6).collect()
    assert [(r["n_rows"], r["n_distinct"], r["low"], r["high"]) for r in got] == [(5000, 1000, 499, 500)]


def test_partitions_follow_the_size(spark, monkeypatch):
    from skeinwork.operators import ranged

    assert ranged.partitions(spark.range(10)) == 4
    monkeypatch.setattr(ranged, "PARTITION_BYTES", 800)
    assert ranged.partitions(spark.range(1000)) == 10
