import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinwork.operators import evaluation as ev
from skeinwork.operators import learned
from skeinwork.operators.candidates import scan, score
from skeinwork.packs import FORUM_CANDIDATES, FORUM_RELEVANCE
from skeinwork.plans import ask as asking
from skeinwork.plans import store
from skeinwork.plans.query_layer import QuerySpec, UnsafeQuery, check_sql, custom_sql, like, run, to_payload
from skeinwork.sources import manifest, readers, sinks


@pytest.fixture(scope="module")
def views(spark):
    docs = spark.createDataFrame([("comment", "a", "S1", "A 100% refund", 3, "u"), ("comment", "b", "s1", "an issue with c:\\x", 9, "u"), ("comment", "c", None, None, 1, "u")], "source_type string, source_id string, subreddit string, analytical_text string, score long, source_url string")
    docs = docs.withColumns({"created_at": F.lit("2021-01-01").cast("timestamp"), "clean_run_id": F.lit("r"), "source_file": F.lit("f"), "manifest_id": F.lit("m")})
    signals = docs.select("source_type", "source_id", "subreddit", F.col("analytical_text").alias("evidence_text"), "score", "created_at", "source_file", "manifest_id", F.lit("pain_point").alias("signal_type"), F.lit(None).cast("string").alias("topic_hint"), F.lit("issue").alias("matched_pattern"))
    entities = signals.select("source_type", "source_id", "subreddit", "created_at", F.lit("t").alias("entity_type"), F.lit("visa").alias("normalized_entity"))
    metrics = spark.createDataFrame([(0, 0, 1), (2, 1, 2)], "comment_count long, submission_count long, pain_point_count long").withColumns({"day": F.lit("2021-01-01").cast("date"), "subreddit": F.lit("s1"), "unique_authors": F.lit(1), "median_score": F.lit(1.0), **{f"{k}_count": F.lit(0) for k in ("feature_request", "recommendation_request", "workaround", "comparison")}})
    return {"research_signals": signals, "entity_mentions": entities, "subreddit_metrics_daily": metrics, "source_documents": docs}


def test_filters_and_payload(views, tmp_path):
    assert run(views, QuerySpec("signal_summary", {"subreddit": " S1 "})).first()["signal_count"] == 2
    assert [r["source_id"] for r in run(views, QuerySpec("source_search")).collect()] == ["b", "a"]
    assert sorted(r["signal_density"] or -1 for r in run(views, QuerySpec("subreddit_metrics")).collect()) == [-1, round(2 / 3, 4)]
    payload = to_payload(run(views, QuerySpec("entity_summary", limit=0)), QuerySpec("entity_summary"), str(tmp_path / "p.json"))
    assert payload["row_count"] == 1 and json.loads((tmp_path / "p.json").read_text())["rows"][0]["mention_count"] == 3
    with pytest.raises(KeyError):
        run(views, QuerySpec("nothing"))


def test_like_has_wildcards_and_plain_backslashes(views):
    docs = views["source_documents"]
    assert docs.filter(like("analytical_text", "100%ref")).count() == 1
    assert docs.filter(like("analytical_text", "C:\\")).count() == 1


@pytest.mark.parametrize("text", ["DROP TABLE x", "SELECT 1; SELECT 2", "SELECT * FROM secrets", "SELECT * FROM parquet.`/etc`", "SELECT * FROM range(5)", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT * FROM source_documents WHERE id IN (SELECT id FROM other)",
    "SELECT java_method('java.lang.System','getProperty','user.dir') FROM research_signals", "SELECT reflect('java.lang.System','getenv','HOME')", "SELECT 1 FROM source_documents WHERE reflect('a','b') = 'c'",
    "SELECT * FROM (WITH inner_one AS (SELECT 1 AS a) SELECT a FROM inner_one) x JOIN inner_one ON true", "WITH a AS (SELECT * FROM b), b AS (SELECT 1 AS x) SELECT * FROM a", "SELECT (SELECT max(x) FROM secrets) FROM research_signals",
    "SELECT input_file_name() FROM source_documents", "SELECT * FROM source_documents ORDER BY java_method('a', 'b')", "SELECT EXISTS (SELECT 1 FROM hidden)", "SELECT * FROM a.source_documents"])
def test_unsafe_sql(spark, text):
    with pytest.raises(UnsafeQuery):
        check_sql(spark, text)


def test_custom_sql(views):
    sql = "WITH t AS (SELECT replace(subreddit, 's', 'x') AS load FROM source_documents) SELECT load, count(*) AS n FROM t GROUP BY load;"
    assert custom_sql(views, QuerySpec("custom_sql", sql=sql, limit=1)).count() == 1
    for text in ("SELECT subreddit, count(*) AS n, row_number() OVER (PARTITION BY subreddit ORDER BY max(score) DESC) AS r FROM source_documents WHERE score > (SELECT avg(score) FROM source_documents) GROUP BY subreddit HAVING count(*) > 0 ORDER BY n DESC",
        "WITH a AS (SELECT 1 AS x), b AS (SELECT x FROM a) SELECT CASE WHEN x = 1 THEN 'y' ELSE upper('n') END AS v FROM b UNION ALL SELECT subreddit FROM source_documents WHERE analytical_text LIKE '%refund%' AND score BETWEEN 1 AND 5"):
        assert custom_sql(views, QuerySpec("custom_sql", sql=text)).count() >= 0


def test_ask(views):
    assert asking.sanitize({"queries": [{"name": "custom_sql"}, {"name": "signal_summary", "filters": {"evil": "x", "subreddit": "s1", "topic_hint": 3}, "limit": 99}, "x"]}) == [QuerySpec("signal_summary", {"subreddit": "s1"}, "", 10)]
    assert {s.name for s in asking.plan("What problems do people have with visas?")} == {"source_search", "signal_summary", "signal_evidence"}
    result = asking.ask(views, "Which issues?", lambda prompt: '{"queries": []}' if prompt.startswith("Plan") else "See q1.r1 and q9.r9")
    assert result["references"] == ["q1.r1"] and result["unknown_references"] == ["q9.r9"]
    assert asking.ask(views, "zzz qqq")["results"][0]["row_count"] > 0  # broadened


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([("a", 2021, "01"), ("b", 2021, "02")], "id string, year long, month string")
    root = str(tmp_path / "root")
    df.write.partitionBy("year", "month").parquet(root)
    got = readers.read_months(spark, root, "2021-02")
    assert [(r["id"], r["year"], r["month"]) for r in got.collect()] == [("b", 2021, "02")]
    with pytest.raises(FileNotFoundError):
        readers.read_months(spark, root, "2020-01")
    with pytest.raises(ValueError):
        readers.months_of("2021-13")
    assert readers.statements("-- c\nSELECT 1;\n\nSELECT 2") == ["SELECT 1", "SELECT 2"]
    (tmp_path / "l.csv").write_text('id,text\n1,"two\nlines ""x"""\n')
    assert readers.read_labels(spark, str(tmp_path / "l.csv")).collect()[0]["text"] == 'two\nlines "x"'
    assert readers.preflight(spark.createDataFrame([("Travel",), ("x",)], "subreddit string"), ["travel"])["rows"] == 1


def test_sinks(spark, tmp_path):
    df = spark.range(5)
    assert sinks.write_parquet(df, str(tmp_path / "t"))["rows"] == 5 and spark.read.parquet(str(tmp_path / "t")).count() == 5
    assert sinks.write_parquet(df.limit(0), str(tmp_path / "z"))["status"] == "completed_zero_rows" and not (tmp_path / "z").exists()
    text = spark.createDataFrame([("a\nb", None)], "x string, y string")
    assert sinks.write_csv(text, str(tmp_path / "c"), "") == 1 and readers.read_labels(spark, str(tmp_path / "c")).count() == 1
    assert sinks.insert_new(spark.range(5), spark.range(3), ["id"]).count() == 2


def test_manifests_and_checkpoints(tmp_path):
    e = [manifest.Entry("comments", "2021-01", f"p{i}", 200) for i in range(3)] + [manifest.Entry("submissions", "2021-01", "q", 50)]
    assert [len(b) for b in manifest.batches(e, 2, 450)] == [2, 1, 1]
    assert [len(b) for b in manifest.batches(e[:2], 5, 100)] == [1, 1]
    assert manifest.build_manifest("r", e).manifest_id == manifest.build_manifest("r", e[::-1]).manifest_id
    (tmp_path / "out").write_text("data")
    c = manifest.Checkpoint("completed", "m", "i", "v", "h", 1, 1, str(tmp_path / "out"), manifest.digest(tmp_path / "out"))
    c.save(tmp_path / "c.json")
    assert manifest.reusable(tmp_path / "c.json", c) == c
    assert manifest.reusable(tmp_path / "c.json", manifest.Checkpoint("", "m", "i", "v2", "h")) is None
    (tmp_path / "out").write_text("changed")
    assert manifest.reusable(tmp_path / "c.json", c) is None
    (tmp_path / "empty").write_text("")
    assert not manifest.usable_output(tmp_path / "empty") and not (tmp_path / "empty").exists()
    assert manifest.capacity(5, 10, 4, 6, 8, 9, 1) == {"state": "warning", "used_bytes": 5, "free_bytes": 10, "can_start_new_batch": True}


def test_store(spark, tmp_path):
    docs = spark.createDataFrame([("comment", "1", "Ann", "tinysaas", "I wish there was an app: looking for csv upload by hand, confusing price", 1), ("comment", "2", " ", "x", "nothing but a plan and some more words to be long enough", 2)], "source_type string, source_id string, author string, subreddit string, text string, score long").withColumn("created_at", F.lit("2021-01-01").cast("timestamp"))
    cands = scan(docs, FORUM_CANDIDATES)
    scored = score(cands, FORUM_RELEVANCE)
    db = store.Store(spark, tmp_path / "db")
    batch = store.Batch("b1", "m", 10, 8)
    salt = store.salt_of(tmp_path / "salt")
    record = db.commit(batch, cands, scored, FORUM_RELEVANCE, salt)
    assert (record["staged"], record["retained"], record["rejected_late"]) == (2, 1, 1) and db.state("b1") == "committed_validated"
    assert db.table("documents").count() == 1 and db.table("document_relevance").count() == 3 and db.table("signals").count() > 0
    assert salt == store.salt_of(tmp_path / "salt") and "Ann" not in str(db.table("documents").collect())
    assert db.commit(batch, cands, scored, FORUM_RELEVANCE, salt)["status"] == "skipped_existing"
    with pytest.raises(ValueError, match="scope"):
        db.commit(store.Batch("b1", "m", 10, 8, True), cands, scored, FORUM_RELEVANCE, salt)
    with pytest.raises(ValueError, match="there already"):
        db.commit(store.Batch("b2", "m", 10, 8), cands, scored, FORUM_RELEVANCE, salt)
    with pytest.raises(ValueError, match="add up"):
        db.commit(store.Batch("b3", "m", 10, 7), cands, scored, FORUM_RELEVANCE, salt)
    assert db.committed() == ["b1"]
    a, b = tmp_path / "a.parquet", tmp_path / "b.parquet"
    a.write_text("a")
    b.write_text("b")
    marks = {str(a): manifest.digest(a), str(b): manifest.digest(b)}
    b.write_text("tampered")
    with pytest.raises(ValueError, match="changed"):
        db.cleanup("b1", marks)
    b.write_text("b")
    folder = tmp_path / "folder"
    spark.range(3).repartition(2).write.parquet(str(folder))
    assert db.files.digest(str(folder)) == manifest.digest(folder)
    states = {r["batch_id"]: r for r in db.lifecycle().collect()}
    assert (states["b1"]["state"], states["b1"]["retained"], states["b1"]["manifest_id"]) == ("committed_validated", 1, "m") and states["b2"]["state"] == "commit_started" and states["b2"]["retained"] is None
    assert not [p for p in (tmp_path / "db" / "documents").iterdir() if "b2" in p.name] and not list((tmp_path / "db" / "_staging").iterdir())
    assert db.cleanup("b1", marks)["removed"] == 2 and db.cleanup("b1", marks)["status"] == "skipped_existing"
    with pytest.raises(ValueError):
        store.apply_migrations(spark, tmp_path / "db", {"001_documents": {"documents": store.MIGRATIONS["003_embeddings"]["document_embeddings"]}})


def test_evaluation(spark):
    scores = spark.createDataFrame([("c", "1", "x", 0.9, "retain"), ("c", "2", "x", 0.7, "retain"), ("c", "3", "x", 0.1, "discard")], "source_type string, source_id string, domain string, relevance_score double, decision string")
    labels = spark.createDataFrame([("1", "1", None), ("2", "0", "trap"), ("3", "1", "")], "source_id string, label_x string, false_positive_category string")
    figures = ev.overall(labels, scores, ["x"])
    assert (figures["precision"], figures["recall"], figures["leakage"]) == (0.5, 0.5, 1.0)
    assert ev.Gate().failures(figures) == ["precision", "recall", "f1", "retained", "leakage"]
    sample = ev.stratified_sample(ev.best_domain(scores), "s", {"retain": 1}, 5)
    assert {(r["sample_stratum"], r["stratum_population"]) for r in sample.collect()} == {("retain", 2), ("discard", 1)} and sample.count() == 2
    done = ev.annotate(labels.select("source_id"), {"x": ["1"]}, {"trap": ["2"]}).collect()
    assert {(r["source_id"], r["label_x"], r["false_positive_category"]) for r in done} == {("1", "1", None), ("2", "0", "trap"), ("3", "0", None)}
    for positives, kinds in (({"x": ["9"]}, {}), ({"x": ["1", "1"]}, {}), ({"x": ["1"]}, {"t": ["1"]}), ({"x": []}, {"t": ["2"], "u": ["2"]})):
        with pytest.raises(ValueError):
            ev.annotate(labels.select("source_id"), positives, kinds)


def test_labels_that_do_not_fit_the_scores(spark):
    """The cases that an evaluation has to refuse."""
    domains = ["x", "y"]
    ids = {"r1": "retain", "r2": "retain", "e1": "evaluate", "e2": "evaluate", "d1": "discard", "d2": "discard"}
    scores = spark.createDataFrame([("c", i, d, 0.5, how if d == "x" else "discard") for i, how in ids.items() for d in domains], "source_type string, source_id string, domain string, relevance_score double, decision string")
    columns = "source_type string, source_id string, sample_stratum string, stratum_population string, sample_rank string, sampling_seed string, label_x string, label_y string"
    good = [["c", i, how, "2", "1", "s", "0", "1"] for i, how in ids.items()]

    def faults(rows, scored=scores):
        return {r["fault"]: r["n"] for r in ev.fixture_faults(spark.createDataFrame(rows, columns), scored, domains).filter("n > 0").collect()}

    def changed(i, place, value):
        return [[value if k == place else v for k, v in enumerate(r)] if r[1] == i else r for r in good]

    assert faults(good) == {}
    ev.require_fixture(spark.createDataFrame(good, columns), scores, domains)
    with pytest.raises(ValueError, match="without the columns"):
        ev.fixture_faults(spark.createDataFrame(good, columns).drop("stratum_population"), scores, domains)
    assert faults(good[1:]) == {"retained_without_label": 1, "retained_difference": 1}
    assert faults(changed("d1", 3, "9")) == {"other_population": 1} and faults(changed("d1", 3, "x")) == {"population_no_number": 1}
    assert faults(changed("r1", 6, None)) == {"invalid_label_x": 1} and faults(changed("r1", 7, "2")) == {"invalid_label_y": 1}
    assert faults(changed("e1", 2, "discard")) == {"other_stratum": 1}
    assert faults([r for r in good if r[2] != "evaluate"]) == {"strata_without_label": 1}
    assert faults([*good, ["c", "z", "discard", "2", "1", "s", "0", "0"]]) == {"unknown_ids": 1, "not_one_score": 2}
    assert faults(good, scores.unionByName(scores.filter("source_id = 'e1' AND domain = 'y'"))) == {"not_one_score": 1}
    assert faults([*good, good[5]]) == {"repeated_ids": 1}
    with pytest.raises(ValueError, match="other_population"):
        ev.require_fixture(spark.createDataFrame(changed("d1", 3, "9"), columns), scores, domains)


def test_calibration_goes_through_all_stages(spark):
    docs = spark.createDataFrame([("comment", "1", "a", "tinysaas", "I wish there was an app: looking for csv upload by hand, confusing price", "u"), ("comment", "2", "b", "tinysaas", "nothing but a plan and some more words to be long enough", "u")], "source_type string, source_id string, author string, subreddit string, text string, source_url string")
    cands = scan(docs, FORUM_CANDIDATES)
    out = ev.calibrate(cands, FORUM_RELEVANCE, {"app_opportunity": ["1"]}, {"other": ["2"]}, "s", ev.Gate(retained=1))
    assert out["failures"] == [] and out["figures"]["precision"] == 1.0 and {d["domain"] for d in out["domains"]} == {d.name for d in FORUM_RELEVANCE.domains}
    with pytest.raises(ValueError, match="unknown ids"):
        ev.calibrate(cands, FORUM_RELEVANCE, {"travel": ["9"]}, {}, "s", ev.Gate())


def test_learned(spark):
    rows = spark.createDataFrame([(f"{i:02}", "broken app" if i % 2 else "nice day", i % 2, 0.1, "evaluate") for i in range(24)], "id string, text string, label int, s double, decision string")
    spec = learned.Features(tuple(learned.vocabulary(rows, "text", 2, 10)), ("s",))
    feats = learned.with_features(rows, "text", spec)
    x, y = learned.matrix(feats, ["id"])
    model = learned.fit(x, y)
    assert np.array_equal(model.weights, learned.fit(x, y).weights) and learned.cross_validate(x, y)["recall"] == 1.0
    at = learned.choose_threshold(y, model.predict(x), 0.9)
    # the step comes before the test: one epoch from zero moves the weights
    assert np.allclose(learned.fit(x, y, epochs=1).weights, -0.5 * x.T @ (0.5 - y) / len(y))
    chance, some = np.array([0.9, 0.8, 0.7, 0.6]), np.array([1.0, 0.0, 1.0, 0.0])
    assert learned.choose_threshold(some, chance, 0.6)["threshold"] == 0.7 and learned.choose_threshold(some, chance, 0.6, np.array([True, False, False, False]))["recall"] == 0.5
    assert learned.choose_threshold(some, chance, 0.9, np.array([False, True, False, True]))["threshold"] == np.inf
    kept = learned.choose_threshold(some, chance, 0.9, np.array([False, True, False, True]), np.array([True, False, False, False]))
    assert kept["selected"] and kept["threshold"] == np.inf and kept["recall"] == 0.5
    up = learned.promote(model.score(feats), at["threshold"])
    assert up.filter("promoted").count() == 12 and up.filter("promoted AND label = 0").count() == 0
    with pytest.raises(ValueError):
        learned.Features((), ("label",))
    with pytest.raises(ValueError):
        learned.matrix(feats, ["id"], most_rows=3)


def test_micro_batches(spark, tmp_path):
    from skeinwork.streaming.micro import run_available

    df = spark.range(4)
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        run_available(spark, str(tmp_path / "in"), df.schema, lambda x: x.filter("id > 1"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
