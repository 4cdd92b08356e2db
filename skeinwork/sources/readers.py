"""Readers: partitioned Parquet by months, several files with their names, CSV, rule relations, SQL files."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files as one table, with the file of each row as ``source_file``."""
    return spark.read.parquet(*paths).withColumn("source_file", F.col("_metadata.file_path"))


def months_of(text: str) -> list[tuple[int, str]] | None:
    """``*`` for all months (None), or ``YYYY-MM,YYYY-MM`` as years and months; anything else is an error."""
    text = text.strip()
    if text in ("", "*"):
        return None
    months = []
    for part in text.split(","):
        m = re.fullmatch(r"\s*(\d{4})-(0[1-9]|1[0-2])\s*", part)
        if not m:
            raise ValueError(f"{part!r} is no month of the form YYYY-MM")
        months.append((int(m[1]), m[2]))
    return months


def read_months(spark: SparkSession, root: str, months: str = "*") -> DataFrame:
    """A dataset partitioned by ``year`` and ``month``: the year as a number, the month as two digits. The choice of months
    is a partition filter; if nothing is there for them, that is an error."""
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        df = spark.read.parquet(root)
    finally:
        spark.conf.set(inference, before)
    chosen = months_of(months)
    if chosen is not None:
        wanted = F.lit(False)
        for year, month in chosen:
            wanted = wanted | ((F.col("year") == str(year)) & (F.col("month") == month))
        df = df.filter(wanted)
        if df.isEmpty():
            raise FileNotFoundError(f"no files of {months} below {root}")
    return df.withColumn("year", F.col("year").cast("bigint"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with all columns as text; fields in quotes may hold line breaks and doubled quotes."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')


def read_statistics(spark: SparkSession, path: str, year: int, months: Iterable[int]) -> DataFrame:
    """Monthly statistics of a CSV file with inferred types."""
    return spark.read.csv(path, header=True, inferSchema=True).filter((F.col("year") == year) & F.col("month").isin(*months)).orderBy("year", "month")


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small relation from code, such as rules."""
    return spark.createDataFrame(list(rows), schema)


def statements(text: str) -> list[str]:
    """The statements of an SQL file: without blank and comment lines, split at semicolons."""
    lines = [line for line in text.splitlines() if line.strip() and not line.strip().startswith("--")]
    return [s.strip() for s in "\n".join(lines).split(";") if s.strip()]


def run_sql_file(spark: SparkSession, path: str) -> list[DataFrame]:
    with open(path) as file:
        return [spark.sql(s) for s in statements(file.read())]


def preflight(df: DataFrame, subreddits: Sequence[str]) -> dict[str, float]:
    """How many rows an ingest of these communities would take, and the seconds it took to count."""
    began = time.time()
    rows = df.filter(F.lower("subreddit").isin(*[s.lower() for s in subreddits])).count()
    return {"rows": rows, "elapsed_seconds": round(time.time() - began, 3)}


def describe(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def ingest(df: DataFrame, subreddits: Sequence[str], manifest_id: str, ingested_at: str) -> DataFrame:
    """The rows of the wanted communities, in any case, with provenance."""
    return df.filter(F.lower("subreddit").isin(*[s.lower() for s in subreddits])).withColumns({"manifest_id": F.lit(manifest_id), "ingested_at": F.lit(ingested_at)})
