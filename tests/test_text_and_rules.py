import pytest
from pyspark.sql import functions as F

from skeinwork import packs
from skeinwork.functions.text import collapse, has_phrase, has_term, is_bot, near, positions, strip_links, tokens
from skeinwork.operators import candidates, cleaning, enrich


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr).first()[0]


@pytest.mark.parametrize(("text", "phrase", "hit"), [
    ("x takes  forever", "takes forever", True), ("mistakes forever", "takes forever", False), ("at booking.com now", "booking.com", True),
    ("bookingxcom", "booking.com", False), ("a vs b", "vs", True), ("obvs", "vs", False), ("takes\nforever", "takes forever", True),
])
def test_phrases(spark, text, phrase, hit):
    assert one(spark, text, has_phrase(F.lower("t"), phrase)) is hit


def test_terms(spark):
    assert one(spark, "the app.", has_term(F.lower("t"), "app")) and not one(spark, "apple", has_term(F.lower("t"), "app"))
    assert one(spark, "xdoesn't workx", has_term(F.lower("t"), "doesn't work"))
    assert one(spark, "see http://a.b/c?app now", strip_links(F.col("t"))) == "see   now"
    assert one(spark, "\na  b\x0bc", collapse(F.trim("t"))) == " a b\x0bc"


@pytest.mark.parametrize(("author", "text", "bot"), [("AutoModerator", "x", True), ("cool_bot", "x", True), ("coolbot", "x", False), (None, "I am a bot, beep", True), ("u", " i am a bot", False), ("u", None, False)])
def test_bots(spark, author, text, bot):
    df = spark.createDataFrame([(author, text)], "a string, t string")
    assert df.select(is_bot(F.col("a"), F.col("t"), cleaning.BOT_STARTS)).first()[0] is bot


def test_proximity(spark):
    words = tokens(F.lower("t"))
    assert one(spark, "my app it doesn't work", positions(words, "doesn't work")) == [3]
    text = "app one two three crashes"
    assert one(spark, text, near(words, ["app"], ["crashes"], 4)) is True
    assert one(spark, text, near(words, ["app"], ["crashes"], 3)) is False
    assert one(spark, "", near(words, ["app"], ["crashes"], 3)) is False


def test_clean_keeps_the_latest_row(spark):
    raw = spark.createDataFrame(
        [("1", "u", "s", "old", 1, "r1", "f"), ("1", "u", "s", "new  text", 1, "r2", "g"), ("1", "u", "s", "other", 1, "r2", "h"), ("2", None, "s", " [Deleted] ", 1, None, None), ("3", "u", "s", None, 1, "r1", "f")],
        "id string, author string, subreddit string, body string, score long, ingested_at string, source_file string",
    )
    got = {r["id"]: r for r in cleaning.clean_comments(raw).collect()}
    assert (got["1"]["body_clean"], got["1"]["raw_duplicate_count"]) == ("new text", 3)
    assert got["2"]["is_deleted"] and got["3"]["text_length"] == 0 and cleaning.clean_comments(raw.limit(0)).count() == 0


def test_submissions_join_title_and_text(spark):
    raw = spark.createDataFrame([("1", "u", "T", "x"), ("2", "u", "T", None), ("3", "u", None, "x")], "id string, author string, title string, selftext string").withColumns({"ingested_at": F.lit("r"), "source_file": F.lit("f")})
    assert {r["id"]: r["combined_text"] for r in cleaning.clean_submissions(raw).collect()} == {"1": "T\n\nx", "2": "T", "3": "x"}


def test_bots_among_submissions_show_in_the_title(spark):
    raw = spark.createDataFrame([("1", "u", "I am a bot, weekly thread", "x"), ("2", "u", "Question", "I am a bot"), ("3", "u", "", "i am a bot"), ("4", "u", "Beep boop", None), ("5", None, None, "I am a bot"), ("6", "a_bot", None, None)], "id string, author string, title string, selftext string").withColumns({"ingested_at": F.lit("r"), "source_file": F.lit("f")})
    # the blank between title and text stands before a text without title
    assert {r["id"] for r in cleaning.clean_submissions(raw).filter("is_bot_like").collect()} == {"1", "4", "6"}


def test_signals_need_a_topic(spark):
    pack = packs.EnrichPack("t", (packs.SignalRule("comparison", "vs", True), packs.SignalRule("pain", "slow")), (packs.EntityRule("a", "visa"), packs.EntityRule("b", "visa"), packs.EntityRule("b", "ferry")))
    df = spark.createDataFrame([("1", "x vs y, slow"), ("2", "visa vs ferry"), ("3", None), ("4", "ferry slow slow")], "source_id string, text string")
    assert {(r["source_id"], r["signal_type"], r["topic_hint"]) for r in enrich.signals(df, pack).collect()} == {("1", "pain", None), ("2", "comparison", "a"), ("4", "pain", "b")}
    assert {(r["source_id"], r["entity_type"], r["normalized_entity"]) for r in enrich.entities(df, pack).collect()} == {("2", "a", "visa"), ("2", "b", "visa"), ("2", "b", "ferry"), ("4", "b", "ferry")}


CANDIDATES = packs.CandidatePack("t", 40, ("[deleted]",), ("travel",), {"pain": ("frustrating", "takes forever"), "travel": ("visa", "refund"), "money": ("refund",), "product": ("app",)})


def candidate_rows(spark):
    rows = [
        ("outside", "randomcity", "The visa process is frustrating and takes forever at the embassy, no refund"),
        ("prior", "Travel", "Nothing of interest here but a long enough text for the scan"),
        ("unrelated", "cats", "Look at this picture of my cat https://x.example/?utm_name=ios_app it is long enough"),
        ("short", "travel", "visa"),
        ("null", None, None),
    ]
    return spark.createDataFrame([("comment", i, "u", s, t) for i, s, t in rows], "source_type string, source_id string, author string, subreddit string, text string")


def test_scan(spark):
    got = {r["source_id"]: r for r in candidates.scan(candidate_rows(spark), CANDIDATES).collect()}
    assert set(got) == {"outside", "prior"}
    assert got["outside"]["matched_rule_groups"] == ["pain", "travel", "money"]
    assert got["outside"]["matched_terms"] == ["frustrating", "takes forever", "visa", "refund", "refund"]
    assert got["prior"]["candidate_reasons"] == ["subreddit_prior"]
    counts = {r["measure"]: r["value"] for r in candidates.scan_counts(candidate_rows(spark), candidates.scan(candidate_rows(spark), CANDIDATES), CANDIDATES).collect()}
    assert counts["rows_seen"] == 5 and counts["rows_candidates"] == 2 and counts["prior_only"] == 1 and counts["group:travel"] == 1


def test_scores_are_exact_at_the_limit(spark):
    # 0.42 + 0.08 + 0.10 - 0.20 is below 0.40 in floating point
    near_rule = packs.Proximity("n", ("visa",), ("embassy",), 50, 0.08)
    pack = packs.RelevancePack("t", (0.8, 0.6, 0.4), (packs.DomainRules("d", 0.0, {"pain": 0.42}, context={"forever": 0.1}, penalties={"embassy": 0.2}, proximity=(near_rule,)), packs.DomainRules("e", 0.1, {"pain": 0.5, "travel": 0.9, "money": 0.2}, required_groups=("money",))))
    got = {(r["source_id"], r["domain"]): r for r in candidates.score(candidates.scan(candidate_rows(spark), CANDIDATES), pack).collect()}
    assert (got["outside", "d"]["relevance_score"], got["outside", "d"]["decision"], got["outside", "d"]["relevance_tier"]) == (0.4, "evaluate", "C")
    assert got["outside", "e"]["relevance_score"] == 1.0 and got["prior", "e"]["relevance_score"] == 0.0
    assert got["outside", "d"]["decision_reasons"] == ["pain", "context:forever", "penalty:embassy", "proximity:n"]
    assert {r["source_id"]: r["decision"] for r in candidates.decisions(candidates.score(candidates.scan(candidate_rows(spark), CANDIDATES), pack)).collect()} == {"outside": "retain", "prior": "discard"}


def test_packs_are_checked(tmp_path):
    with pytest.raises(ValueError):
        packs.CandidatePack("v", 1, (), (), {"g": ("a", "a")})
    with pytest.raises(ValueError):
        packs.RelevancePack("v", (0.5, 0.6, 0.4), (packs.DomainRules("d", 0.1, {"g": 0.1}),))
    with pytest.raises(ValueError):
        packs.DomainRules("d", 0.1, {"g": 0.1}, required_groups=("h",))
    with pytest.raises(ValueError):
        packs.Proximity("p", ("a",), ("b",), 51, 0.1)
    path = tmp_path / "pack.yaml"
    path.write_text("version: v\nminimum_length: 3\nexcluded: []\npriors: [a]\ngroups: {g: [x, y]}\n")
    pack = packs.load(str(path), packs.CandidatePack)
    assert pack.groups == {"g": ("x", "y")} and packs.fingerprint(pack) == packs.fingerprint(packs.CandidatePack("v", 3, (), ("a",), {"g": ("x", "y")}))
