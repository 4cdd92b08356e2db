"""The durable store: Parquet tables by batch, published by one marker.

A batch is staged table by table, checked, moved into place and made visible by a marker file that is renamed last.
Readers see batches with a marker only, so a failed or half-written batch never shows. A log of events, of which the
latest counts, takes the place of status updates.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.operators.evaluation import KEY
from skeinwork.packs import RelevancePack
from skeinwork.plans.review import batch_checksum
from skeinwork.sources.files import Files
from skeinwork.sources.manifest import stable_id

S, D, L, B, A, TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.ArrayType(T.StringType()), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


#: versioned table definitions; a change of a released version is an error
MIGRATIONS: dict[str, dict[str, T.StructType]] = {
    "001_documents": {"documents": _schema(document_id=S, source_type=S, source_id=S, author_hash=S, subreddit=S, score=L, created_at=TS, text=S, ingest_batch_id=S)},
    "002_findings": {
        "document_relevance": _schema(document_id=S, domain=S, relevance_score=D, relevance_tier=S, decision=S, decision_reasons=A, relevance_version=S, ingest_batch_id=S),
        "signals": _schema(signal_id=S, document_id=S, signal_type=S, rule_group=S, ingest_batch_id=S),
        "entities": _schema(document_id=S, normalized_entity=S, ingest_batch_id=S),
    },
    "003_embeddings": {"document_embeddings": _schema(document_id=S, model=S, embedding=T.ArrayType(T.FloatType()), ingest_batch_id=S)},
}


def apply_migrations(spark: SparkSession, root: str | Path, migrations: dict[str, dict[str, T.StructType]] = MIGRATIONS) -> list[str]:
    """Records the versions that are new, in order; the checksums of those recorded before must not have changed."""
    files, path = Files(spark), f"{root}/_migrations.json"
    known = files.read_json(path) or {}
    added = []
    for version in sorted(migrations):
        mark = hashlib.sha256("".join(f"{n}:{s.json()}" for n, s in sorted(migrations[version].items())).encode()).hexdigest()
        if version not in known:
            added.append(version)
        if known.setdefault(version, mark) != mark:
            raise ValueError(f"{version} was changed after it was applied")
    if added:
        files.write_json(path, known)
    return added


def salt_of(path: str | Path) -> str:
    """A secret kept in a file of the owner, made at first use."""
    path = Path(path)
    if not path.exists():
        path.parent.mkdir(parents=True, exist_ok=True)
        with os.fdopen(os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600), "w") as out:
            out.write(uuid.uuid4().hex)
    return path.read_text().strip()


def author_hash(author: Column, salt: str) -> Column:
    return F.when(author.isNotNull() & (F.trim(author) != ""), F.sha2(F.concat(F.lit(f"{salt}:"), F.lower(author)), 256))


@dataclass(frozen=True)
class Batch:
    batch_id: str
    manifest_id: str
    rows_seen: int
    rejected_early: int
    with_review_tier: bool = False


class Store:
    def __init__(self, spark: SparkSession, root: str | Path):
        self.spark, self.root, self.files = spark, str(root).rstrip("/"), Files(spark)
        apply_migrations(spark, self.root)

    def committed(self) -> list[str]:
        return [name.removesuffix(".json") for name in self.files.names(f"{self.root}/_committed") if name.endswith(".json")]

    def table(self, name: str) -> DataFrame:
        """A table over all committed batches."""
        schema = next(tables[name] for tables in MIGRATIONS.values() if name in tables)
        there = set(self.files.names(f"{self.root}/{name}"))
        paths = [f"{self.root}/{name}/ingest_batch_id={b}" for b in self.committed() if f"ingest_batch_id={b}" in there]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def log(self, batch_id: str, event: str, **facts: Any) -> None:
        at = datetime.now(UTC).isoformat(timespec="microseconds")
        self.files.write_json(f"{self.root}/_events/{batch_id}/{at.replace(':', '')}-{event}.json", {"batch_id": batch_id, "event": event, "at": at, **facts})

    def state(self, batch_id: str) -> str | None:
        names = [n for n in self.files.names(f"{self.root}/_events/{batch_id}") if n.endswith(".json")]
        return self.files.read_json(f"{self.root}/_events/{batch_id}/{names[-1]}")["event"] if names else None

    def lifecycle(self) -> DataFrame:
        """``batch_id, state, at`` of every batch that ever began, with ``manifest_id, staged, retained, rejected_late,
        with_review_tier`` of its record where it was committed: the latest event joined with the record."""
        events = self.spark.read.schema("batch_id string, event string, at string").option("multiLine", True).option("recursiveFileLookup", True)
        facts = "batch_id string, manifest_id string, staged long, retained long, rejected_late long, with_review_tier boolean"
        if not self.files.names(f"{self.root}/_events"):
            return self.spark.createDataFrame([], f"batch_id string, state string, at string, {facts.partition(', ')[2]}")
        last = events.json(f"{self.root}/_events").groupBy("batch_id").agg(F.max_by("event", "at").alias("state"), F.max("at").alias("at"))
        done = f"{self.root}/_committed"
        records = self.spark.read.schema(facts).option("multiLine", True).json(done) if self.committed() else self.spark.createDataFrame([], facts)
        return last.join(records, "batch_id", "left")

    def commit(self, batch: Batch, candidates: DataFrame, scores: DataFrame, pack: RelevancePack, salt: str) -> dict[str, Any]:
        """Publishes the retained candidates (and those of the review tier, if wanted) with relevance, signals and entities.

        The same batch again is skipped; the same batch with another scope is an error. Everything is checked before
        the marker is set: unique candidates, a score for each domain, one version, no orphans, no document that is
        there already, and that seen = rejected early + staged and staged = retained + rejected late.
        """
        marker = f"{self.root}/_committed/{batch.batch_id}.json"
        if old := self.files.read_json(marker):
            if old["with_review_tier"] != batch.with_review_tier:
                raise ValueError("the batch was committed with another scope")
            return old | {"status": "skipped_existing"}
        self.log(batch.batch_id, "commit_started")
        staged = candidates.count()
        facts = candidates.agg(F.countDistinct(F.struct(*KEY)).alias("ids")).crossJoin(
            scores.agg(F.count(F.lit(1)).alias("scores"), F.countDistinct(F.struct(*KEY, "domain")).alias("pairs"), F.countDistinct("relevance_version").alias("versions"))
        ).first()
        domains = len(pack.domains)
        self._require(facts["ids"] == staged, "candidates are not unique")
        self._require(facts["scores"] == facts["pairs"] == staged * domains, "not one score for each candidate and domain")
        self._require(facts["versions"] <= 1, "scores of several versions")
        self._require(scores.join(candidates, KEY, "left_anti").isEmpty(), "scores without candidate")
        self._require(batch.rows_seen == batch.rejected_early + staged, "seen rows do not add up")
        wanted = ["retain", "evaluate"] if batch.with_review_tier else ["retain"]
        chosen = scores.filter(F.col("decision").isin(*wanted)).select(*KEY).distinct()
        doc_id = F.concat_ws(":", *KEY)
        documents = candidates.join(chosen, KEY, "left_semi").select(doc_id.alias("document_id"), *KEY, author_hash(F.col("author"), salt).alias("author_hash"), "subreddit", F.col("score").cast("long").alias("score"), F.col("created_at").cast("timestamp").alias("created_at"), F.col("candidate_text").alias("text"))
        self._require(documents.join(self.table("documents"), "document_id", "left_semi").isEmpty(), "a document is there already")
        relevance = scores.join(chosen, KEY, "left_semi").select(doc_id.alias("document_id"), "domain", "relevance_score", "relevance_tier", "decision", "decision_reasons", "relevance_version")
        groups = candidates.join(chosen, KEY, "left_semi").select(doc_id.alias("document_id"), F.explode("matched_rule_groups").alias("rule_group"))
        kinds = self.spark.createDataFrame(list(pack.signal_of_group.items()), "rule_group string, signal_type string")
        signals = groups.join(F.broadcast(kinds), "rule_group")  # one row per rule group
        signals = signals.select(F.substring(F.sha2(F.concat_ws("\0", "document_id", "signal_type", "rule_group"), 256), 1, 24).alias("signal_id"), "document_id", "signal_type", "rule_group").distinct()
        entities = candidates.join(chosen, KEY, "left_semi").select(doc_id.alias("document_id"), F.explode("matched_terms").alias("normalized_entity")).distinct()
        place = f"{self.root}/_staging/{batch.batch_id}-{uuid.uuid4().hex}"
        tables = {"documents": documents, "document_relevance": relevance, "signals": signals, "entities": entities}
        try:
            for name, df in tables.items():
                df.withColumn("ingest_batch_id", F.lit(batch.batch_id)).write.option("compression", "zstd").parquet(f"{place}/{name}")
            back = {name: self.spark.read.parquet(f"{place}/{name}") for name in tables}
            retained = back["documents"].count()
            self._require(back["document_relevance"].count() == retained * domains, "relevance rows do not match the documents")
            self._require(back["signals"].join(back["documents"], "document_id", "left_anti").isEmpty(), "signals without document")
            check = batch_checksum(back["documents"].select(F.col("document_id").alias("id"))).first()
            for name in tables:
                # what an attempt without marker left there was never seen
                target = f"{self.root}/{name}/ingest_batch_id={batch.batch_id}"
                self.files.delete(target)
                self.files.move(f"{place}/{name}", target)
        finally:
            self.files.delete(place)
        record = {"status": "committed_validated", "batch_id": batch.batch_id, "manifest_id": batch.manifest_id, "with_review_tier": batch.with_review_tier, "rows_seen": batch.rows_seen, "rejected_early": batch.rejected_early, "staged": staged, "retained": retained, "rejected_late": staged - retained, "checksum": check["checksum"]}
        self.log(batch.batch_id, "committed_validated")
        self.files.write_json(marker, record)
        return record

    @staticmethod
    def _require(condition: bool, what: str) -> None:
        if not condition:
            raise ValueError(f"commit refused: {what}")

    def cleanup(self, batch_id: str, staged: dict[str, str]) -> dict[str, Any]:
        """Removes staged files, given with their digests, of a committed batch whose documents still match its checksum. A
        file that differs from its digest is refused; one that is gone was removed before."""
        record = self.files.read_json(f"{self.root}/_committed/{batch_id}.json")
        if not record:
            raise ValueError("the batch is not committed")
        ids = self.table("documents").filter(F.col("ingest_batch_id") == batch_id).select(F.col("document_id").alias("id"))
        check = batch_checksum(ids).first()
        if record["retained"] != (check["documents"] or 0) or (record["retained"] and check["checksum"] != record["checksum"]):
            raise ValueError("the store does not match the batch's record")
        there = {p: d for p, d in staged.items() if self.files.exists(p)}
        if not there:
            return {"status": "skipped_existing", "removed": 0}
        for path, expected in there.items():
            if self.files.digest(path) != expected:
                raise ValueError(f"{path} was changed after it was staged")
        self.log(batch_id, "cleanup_started", files=sorted(there))
        for path in there:
            self.files.delete(path)
        self.log(batch_id, "cleaned", files=sorted(there))
        return {"status": "cleaned", "removed": len(there)}


__all__ = ["Batch", "MIGRATIONS", "Store", "apply_migrations", "salt_of", "stable_id"]
