"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm.canonical import look_classes, same_look, unify
from skeinwork.llm.capping import cap
from skeinwork.llm.encoding import count_tokens, encode
from skeinwork.llm.mixing import Mixture, mix
from skeinwork.llm.joining import attach
from skeinwork.llm.neardup import NearDuplicates, equal_words, near_duplicates
from skeinwork.llm.pii import detect, learn
from skeinwork.llm.sampling import frozen_sample, keep_sample
from skeinwork.llm.topn import top_n
from skeinwork.operators.records import current_rows, norm_name
from skeinwork.plans.common import REVIEW, table
from skeinwork.scratch import materialize

RATE = 0.1


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = current_rows(table(spark, sf_dir, "source_documents"), ["author", "year", "month", "score"])
    records = records.withColumn("author", norm_name("author"))
    limited = F.col("author").isNotNull() & ~F.col("author").isin("", "[deleted]")
    return cap(records, ["author", "year", "month"], "score", "source_id", most=10, limited=limited)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir).filter(~F.col("kept")).select("source_id")


def p2_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir).filter("kept").select("source_id", "author", "year", "month", "score")


def _latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "scores").withColumn("pair", F.struct("source_id", "domain")), ["source_id", "domain", "relevance_score"], "pair", "scored_at").drop("pair").filter("source_id IS NOT NULL")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = current_rows(table(spark, sf_dir, "source_documents"), ["subreddit", "year", "month"])
    records = records.withColumn("subreddit", norm_name("subreddit")).filter("subreddit IS NOT NULL AND subreddit <> ''")
    items = _latest_scores(spark, sf_dir).filter("relevance_score IS NOT NULL").join(records, "source_id")
    return top_n(items, ["domain", "subreddit", "year", "month"], "relevance_score", "source_id", 3).select("domain", "source_id")


def _ledger(spark: SparkSession, name: str) -> str | None:
    """Where arrivals are kept: below the folder that the setting ``spark.skeinwork.ledgers`` names."""
    root = spark.conf.get("spark.skeinwork.ledgers", None)
    return f"{root.rstrip('/')}/{name}" if root else None


def p5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of records with the latest scoring of each domain. A batch is the UTC day of a record's first scoring.

    With a ledger a record stays in the batch in which it arrived, whatever scorings come later or turn up with an older
    time, and every record is in a batch at once. Without one the batches are made from the table alone: then a day
    counts as soon as a scoring of a later day shows that it is over, so that later scorings change no pick."""
    scores = table(spark, sf_dir, "scores")
    arrivals = scores.select("source_id", F.to_date("scored_at").alias("batch"))
    if ledger := _ledger(spark, "scores"):
        picks = keep_sample(ledger, arrivals, "source_id", RATE, "scores-v1", "batch")
    else:
        open_day = arrivals.agg(F.max("batch")).first()[0]
        picks = frozen_sample(arrivals, "source_id", "batch", RATE, "scores-v1").filter(F.col("batch") < F.lit(open_day))
        picks = picks.select("source_id", F.date_format("batch", "yyyy-MM-dd").alias("batch"))
    return _latest_scores(spark, sf_dir).join(picks, "source_id").select("source_id", "domain", "relevance_score", "batch")


def p5_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the review sample. Its rows have no time of arrival, so only a ledger tells batches apart: ids that are
    new there are one more batch. Without one the table counts as the first batch."""
    review = table(spark, sf_dir, REVIEW)
    if ledger := _ledger(spark, REVIEW):
        picks = keep_sample(ledger, review, "source_id", RATE, "review-v1")
    else:
        picks = frozen_sample(review.select("source_id", F.lit("").alias("batch")), "source_id", "batch", RATE, "review-v1")
    return review.join(picks.select("source_id"), "source_id").select("source_id", "label_travel", "label_saas_opportunity", "label_app_opportunity", "false_positive_category").distinct()


def _personal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What was found in the records and in the excerpts of the review sample.

    An excerpt is the cut start of a record's text. Whether an item at the cut is there in full shows in the record, so
    the record's text is searched and items that end within the excerpt count; excerpts of unknown records, or that
    differ from their record, are searched as they are.
    """
    docs = table(spark, sf_dir, "source_documents").select("source_id", "analytical_text")
    known = learn(docs, "analytical_text")
    found = materialize(detect(docs, "analytical_text", known, ["source_id"]), "pii")
    review = table(spark, sf_dir, REVIEW).select("source_id", "text_excerpt").distinct()
    ids = materialize(review.select("source_id").filter("source_id IS NOT NULL").distinct(), "ids")
    texts = attach(docs.filter("source_id IS NOT NULL"), ids, ["source_id"], "source_id", ids.count()).dropDuplicates(["source_id"])
    cut = review.join(texts, "source_id", "left").withColumn("upto", F.length("text_excerpt"))
    cut = cut.withColumn("whole", F.when(F.col("analytical_text").startswith(F.col("text_excerpt")), F.col("analytical_text")).otherwise(F.col("text_excerpt")))
    return found, detect(cut, "whole", known, ["source_id", "text_excerpt"], "upto")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, excerpts = _personal(spark, sf_dir)
    both = records.select(F.lit("source_documents").alias("record_table"), "source_id", F.explode("pii_types").alias("pii_type")).unionByName(
        excerpts.select(F.lit("review_sample").alias("record_table"), "source_id", F.explode("pii_types").alias("pii_type"))
    )
    return both.distinct()


def p6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both texts with placeholders: one row per record, and one per excerpt that differs."""
    records, excerpts = _personal(spark, sf_dir)
    both = records.select(F.lit("source_documents").alias("record_table"), "source_id", F.col("redacted").alias("text")).dropDuplicates(["source_id"])
    return both.unionByName(excerpts.select(F.lit("review_sample").alias("record_table"), "source_id", F.col("redacted").alias("text")).distinct())


def _repeats(spark: SparkSession, sf_dir: str) -> NearDuplicates:
    return near_duplicates(table(spark, sf_dir, "source_documents"), "source_id", "analytical_text", agreement=0.6, width=3, min_words=40)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repeats(spark, sf_dir).pairs()


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by class of near-equal text: five words to a sequence, similarity of 0.8. Texts too short for a sequence
    are in one class with those of the same words, null texts by themselves; every record has a row."""
    docs = table(spark, sf_dir, "source_documents")
    long = materialize(near_duplicates(docs, "source_id", "analytical_text").classes(), "classes")
    return long.unionByName(equal_words(docs.join(long.select("source_id"), "source_id", "left_anti"), "source_id", "analytical_text"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def _mixture(spark: SparkSession, sf_dir: str) -> Mixture:
    # the range sort reads its input twice, the tokenizer is to run once
    sized = materialize(count_tokens(table(spark, sf_dir, "documents"), "text", ["doc_id", "source"]), "sizes")
    return mix(sized, table(spark, sf_dir, "source_weights"), "doc_id", "source", "n_tokens")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).picks


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).report


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_look(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the class of the texts that look like its own."""
    return look_classes(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(table(spark, sf_dir, "documents"), "text").select("doc_id", "canonical_text")


QUERIES = {
    "p2_found": p2_found,
    "p2_kept": p2_kept,
    "p4_found": p4_found,
    "p5_scores": p5_scores,
    "p5_review": p5_review,
    "p6_found": p6_found,
    "p6_texts": p6_texts,
    "p7_found": p7_found,
    "p7_classes": p7_classes,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_classes": p10_classes,
    "p10_texts": p10_texts,
}

_CURRENT = """current_docs AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY clean_run_id DESC) AS rn FROM source_documents) WHERE rn = 1
)"""

_RANKED = f"""WITH {_CURRENT},
ranked AS (
  SELECT source_id, lower(trim(author)) AS author, year, month, score,
    row_number() OVER (PARTITION BY lower(trim(author)), year, month ORDER BY score DESC NULLS LAST, source_id) AS place
  FROM current_docs
)"""

_LATEST = """latest AS (
  SELECT source_id, domain, relevance_score FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, domain ORDER BY scored_at DESC) AS rn FROM scores WHERE source_id IS NOT NULL
  ) WHERE rn = 1
)"""

SQL = {
    "p2_found": f"{_RANKED} SELECT source_id FROM ranked WHERE place > 10 AND author IS NOT NULL AND author NOT IN ('', '[deleted]')",
    "p2_kept": f"{_RANKED} SELECT source_id, author, year, month, score FROM ranked WHERE place <= 10 OR author IS NULL OR author IN ('', '[deleted]')",
    "p4_found": f"""WITH {_CURRENT}, {_LATEST},
placed AS (
  SELECT domain, l.source_id,
    row_number() OVER (PARTITION BY domain, lower(trim(subreddit)), year, month ORDER BY relevance_score DESC, l.source_id) AS place
  FROM latest l JOIN current_docs d ON l.source_id = d.source_id
  WHERE relevance_score IS NOT NULL AND trim(subreddit) <> ''
)
SELECT domain, source_id FROM placed WHERE place <= 3""",
    "p5_scores": f"""WITH {_LATEST},
arrived AS (SELECT source_id, CAST(min(scored_at) AS DATE) AS batch FROM scores WHERE source_id IS NOT NULL GROUP BY 1),
placed AS (
  SELECT source_id, batch, row_number() OVER (PARTITION BY batch ORDER BY md5('scores-v1:' || source_id), source_id) AS place,
    count(*) OVER (PARTITION BY batch) AS size
  FROM arrived
)
SELECT l.source_id, l.domain, l.relevance_score, strftime(p.batch, '%Y-%m-%d') AS batch
FROM placed p JOIN latest l ON p.source_id = l.source_id
WHERE place <= ceil(round(CAST({RATE} AS DOUBLE) * size, 9)) AND p.batch < (SELECT CAST(max(scored_at) AS DATE) FROM scores)""",
    "p5_review": f"""WITH placed AS (
  SELECT source_id, row_number() OVER (ORDER BY md5('review-v1:' || source_id), source_id) AS place, count(*) OVER () AS size
  FROM (SELECT DISTINCT source_id FROM {REVIEW} WHERE source_id IS NOT NULL)
)
SELECT DISTINCT r.source_id, label_travel, label_saas_opportunity, label_app_opportunity, false_positive_category
FROM {REVIEW} r JOIN placed p ON r.source_id = p.source_id WHERE place <= ceil(round(CAST({RATE} AS DOUBLE) * size, 9))""",
    "p7_found": """WITH texts AS (SELECT source_id, min(analytical_text) AS text FROM source_documents WHERE source_id IS NOT NULL AND analytical_text IS NOT NULL GROUP BY 1),
worded AS (SELECT source_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM texts),
sequences AS (
  SELECT DISTINCT source_id, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS seq
  FROM worded WHERE len(words) >= 40
),
sizes AS (SELECT source_id, count(*) AS size FROM sequences GROUP BY 1),
common AS (SELECT a.source_id AS x, b.source_id AS y, count(*) AS n FROM sequences a JOIN sequences b ON a.seq = b.seq AND a.source_id < b.source_id GROUP BY 1, 2)
SELECT x AS source_id_a, y AS source_id_b FROM common JOIN sizes p ON x = p.source_id JOIN sizes q ON y = q.source_id WHERE n * 5 >= 3 * (p.size + q.size - n)""",
}
