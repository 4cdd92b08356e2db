"""What a review found missing in the training-data operators."""

from hashlib import md5
from math import ceil

import pytest
from pyspark.sql import functions as F

from skeinwork.llm import pii, queries


def found(spark, texts, extra=()):
    df = spark.createDataFrame([(f"t{i}", t) for i, t in enumerate([*texts, *extra])], "id string, text string")
    known = pii.learn(df, "text")
    return known.collect(), [r["redacted"] for r in pii.detect(df.orderBy("id").limit(len(texts)) if not extra else df.filter(F.substring("id", 2, 9).cast("int") < len(texts)), "text", known, ["id"]).orderBy(F.substring("id", 2, 9).cast("int")).collect()]


def test_names_do_not_hang_on_the_size_of_the_table(spark):
    known, texts = found(spark, [
        "Thanks for the help. Regards, Anton Wyckenko",
        "My name is Elin Wyckvick and I have been waiting.",
        "The room was cold. Bruno T. Navaramis never got the parcel.",
        "Later Wyckenko, Anton came back and Greta Navaramis did not.",
        "Regards, The team. Two-Step Login is slow, so is Upper Oskostad.",
    ])
    assert texts[:3] == ["Thanks for the help. Regards, [NAME]", "My name is [NAME] and I have been waiting.", "The room was cold. [NAME] never got the parcel."]
    assert texts[3].startswith("Later [NAME] came back") and texts[4].startswith("Regards, The team. Two-Step Login") and "[NAME]" not in texts[4]
    assert ("l", "regards,") in known.contexts and "anton" in known.givens


def test_a_cue_beside_a_number_needs_no_learning(spark):
    orders = [f"My order {n} came late, {w} of May." for n in range(20000000, 20000040) for w in ("first", "third")]
    known, texts = found(spark, ["They asked for my SSN, which is 666-95-6193", "passport no X22888753 expired", "My passport no 20770001 was refused.", "One for renewing passports. Order 20770002 is open."], orders)
    assert texts == ["They asked for my SSN, which is [ID_NUMBER]", "passport no [ID_NUMBER] expired", "My passport no [ID_NUMBER] was refused.", "One for renewing passports. Order 20770002 is open."]
    assert ("number", "dddddddd") not in known.forms


def test_all_numbers_of_a_run():
    forms = {("number", "0dd dddd dddd"): "phone", ("number", "0dddd ddd ddd"): "phone", ("house", "n * court"): "address"}
    finder = pii.Finder(pii.Knowledge(forms, set(), set()))
    for text, want in [
        ("call 020 7946 0958 / 020 7946 0959", ["020 7946 0958", "020 7946 0959"]),
        ("tel 07700 900 962. 07700 900 963 is new", ["07700 900 962", "07700 900 963"]),
        ("020 7946 0958 020 7946 0959 ok", ["020 7946 0958", "020 7946 0959"]),
        ("order 4421-99812 / 020 7946 0958", ["020 7946 0958"]),
        ("at 07700 900 962 40 Lunebton Court now", ["07700 900 962", "40 Lunebton Court"]),
        ("card 4111 1111 1111 1111 was lost", []),
    ]:
        assert [text[b:e] for b, e, _ in finder.items(text)] == want


def test_every_record_has_a_class(spark, tmp_path):
    long = "one two three four five six seven"
    texts = [("a", "Same here."), ("b", "same HERE"), ("c", None), ("d", None), ("e", ""), ("f", "да"), ("g", "нет"), ("h", long), ("i", long), ("a", "Same here."), ("j", "👍"), ("k", "👎"), ("l", " ")]
    spark.createDataFrame(texts, "source_id string, analytical_text string").write.parquet(f"{tmp_path}/source_documents.parquet")
    rows = [tuple(r) for r in queries.p7_classes(spark, str(tmp_path)).collect()]
    own = {"c", "d", "f", "g", "j", "k"}
    assert sorted(rows) == sorted([("a", "a", 0), ("b", "a", 0), ("e", "e", 0), ("l", "e", 0), ("h", "h", 0), ("i", "h", 0), *((x, x, 0) for x in own)])


def test_a_grown_review_table_keeps_every_pick(spark, tmp_path):
    ids = [f"r{i:03}" for i in range(300)]

    def as_one_batch(some):
        return set(sorted(some, key=lambda i: md5(f"review-v1:{i}".encode()).hexdigest())[: ceil(round(0.1 * len(some), 9))])

    early = next(ids[:n] for n in range(200, 300) if not as_one_batch(ids[:n]) <= as_one_batch(ids))
    for name, some in (("early", early), ("grown", ids)):
        rows = [(i, "0", "1", None, None) for i in some]
        frame = spark.createDataFrame(rows, "source_id string, label_travel string, label_saas_opportunity string, label_app_opportunity string, false_positive_category string")
        frame.write.parquet(f"{tmp_path}/{name}/{queries.REVIEW}.parquet")
    spark.conf.set("spark.skeinwork.ledgers", f"{tmp_path}/ledgers")
    try:
        first, again, grown, last = ({r["source_id"] for r in queries.p5_review(spark, f"{tmp_path}/{name}").collect()} for name in ("early", "early", "grown", "grown"))
    finally:
        spark.conf.unset("spark.skeinwork.ledgers")
    assert first == again == as_one_batch(early) and first < grown == last
    assert len(grown) == len(first) + ceil(0.1 * (300 - len(early)))


def test_more_knowledge_than_may_be_broadcast_gives_the_same(spark):
    """Entries then come to each chunk of the documents by a join; one row is all that may be broadcast."""
    from test_problems import letters

    cases = letters(400)
    df = spark.createDataFrame([(i, t) for i, t, _ in cases] + [("null", None), ("empty", "")], "id string, text string").repartition(5)
    few, many = pii.learn(df, "text", most=1), pii.learn(df, "text")
    assert few.collect() == many.collect() and len(many.collect().families) > 5
    for upto in (None, "n"):
        rows = df.withColumn("n", F.lit(70))
        assert sorted(map(str, pii.detect(rows, "text", few, ["id"], upto).collect())) == sorted(map(str, pii.detect(rows, "text", many, ["id"], upto).collect()))


def test_items_of_any_length():
    finder = pii.Finder(pii.Knowledge({}, {"anna" * 30}, {"berg" * 30}, {("l", "wrote to")}))
    local = "a" * 60 + "." + "b" * 64
    for text, want in [
        (f"Write to {local}@mail.example now", [f"{local}@mail.example"]),
        (f"It was {'anna' * 30} {'berg' * 30} again", [f"{'anna' * 30} {'berg' * 30}"]),
        (f"box at {'Lang' * 30}strasse 12 there", [f"{'Lang' * 30}strasse 12"]),
        ("my passport " + "x" * 300 + " AB1234567", ["AB1234567"]),
        (f"We wrote to {'Carl' * 30} {'Dorn' * 30} twice", [f"{'Carl' * 30} {'Dorn' * 30}"]),
    ]:
        assert [text[b:e] for b, e, _ in finder.items(text)] == want


def test_a_rare_form_is_learnt_in_a_small_corpus_and_a_chance_one_not_in_a_large_one(spark):
    calls = [f"Call me on +44 7700 90012{i} after six." for i in range(8)]
    known, _ = found(spark, ["Call me on 555/0199/22 after six."], calls)
    assert known.forms.get(("number", "ddd/dddd/dd")) == "phone"
    others = [f"{w} 555/0{n}/22 {v} {w}." for n, w in enumerate(["part", "item", "lot", "code", "shelf", "gate", "page", "seat"], 100) for v in ("is", "was", "in", "of")]
    known, _ = found(spark, ["Call me on 555/0199/22 after six."], calls + others)
    assert ("number", "ddd/dddd/dd") not in known.forms
