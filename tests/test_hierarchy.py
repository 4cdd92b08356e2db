import random

from skeinwork.operators.hierarchy import Hierarchy, descendants, thread_parent


def brute(links):
    parent = {i: p if p in links else None for i, p in links.items()}
    paths, endless = {}, {}
    for node in parent:
        chain, at = [], node
        while at is not None and at not in chain:
            chain.append(at)
            at = parent[at]
        if at is None:
            paths[node] = chain[::-1]
        else:
            endless[node] = min(chain[chain.index(at) :])
    return paths, endless


def check(spark, links):
    tree = Hierarchy(spark.createDataFrame(list(links.items()), "source_id string, parent_id string"))
    paths, endless = brute(links)
    assert {r["id"]: r["cycle_id"] for r in tree.cycles.collect()} == endless
    nodes = tree.nodes(with_path=True)
    got = {r["id"]: r for r in nodes.collect()}
    assert {i: r["path"] for i, r in got.items()} == paths
    for i, r in got.items():
        below = [j for j, p in paths.items() if i in p]
        assert (r["root"], r["depth"], r["size"]) == (paths[i][0], len(paths[i]) - 1, len(below))
        inside = {j for j, q in got.items() if q["root"] == r["root"] and r["preorder"] <= q["preorder"] < r["preorder"] + r["size"]}
        assert inside == set(below)
    pairs = {(r["ancestor"], r["id"]) for r in descendants(nodes).collect()}
    assert pairs == {(a, i) for i, p in paths.items() for a in p[:-1]}


def test_random_forest_with_cycles(spark):
    r = random.Random(5)
    links = {f"n{i:03}": r.choice([None, "gone", *[f"n{r.randrange(120):03}"] * 8]) for i in range(120)}
    links |= {"loop": "loop", "x1": "x2", "x2": "x3", "x3": "x1", "tail1": "x1", "tail2": "tail1"}
    check(spark, links)


def test_deep_chain_and_wide_star(spark):
    links = {f"c{i:03}": f"c{i - 1:03}" if i else None for i in range(70)} | {f"s{i:03}": "c000" for i in range(60)}
    check(spark, links)


def test_long_cycle_with_long_tail(spark):
    links = {f"l{i:02}": f"l{(i + 1) % 13:02}" for i in range(13)} | {f"t{i:02}": f"t{i - 1:02}" if i else "l05" for i in range(20)}
    check(spark, links)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "b", 2), ("b", None, 3), (None, "a", 4), ("a", "b", 2)], "source_id string, parent_id string, root long")
    got = {r["id"]: r["parent"] for r in Hierarchy(df).nodes().collect()}
    assert got == {"a": "b", "b": None}
    empty = Hierarchy(df.limit(0))
    assert empty.cycles.count() == 0 and empty.nodes().count() == 0


def test_parent_forms(spark):
    df = spark.createDataFrame([("t1_ab",), (" T3_ab ",), ("ab",), ("\tt1_ab\n",), (None,), ("t1_",)], "p string")
    assert [r[0] for r in df.select(thread_parent("p")).collect()] == ["ab", "ab", "ab", "ab", None, None]
