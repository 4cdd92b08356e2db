"""Manifests of archive shards, batching of shards, checkpoints and run records. Plain files on the driver."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Entry:
    record_type: str
    month: str
    path: str
    size: int
    revision: str = ""

    @property
    def identity(self) -> str:
        """The same for the same shard, whenever and wherever it is listed."""
        return stable_id(self.record_type, self.month, self.path, self.revision)


@dataclass
class Manifest:
    repo: str
    entries: list[Entry] = field(default_factory=list)

    @property
    def manifest_id(self) -> str:
        return stable_id(self.repo, *[e.identity for e in self.entries])


def stable_id(*parts: str, length: int = 16) -> str:
    return hashlib.sha256(b"".join(p.encode() + b"\0" for p in parts)).hexdigest()[:length]


def list_shards(root: str, record_type: str, month: str, revision: str = "") -> list[Entry]:
    """The Parquet files of a folder, by path."""
    return [Entry(record_type, month, str(p), p.stat().st_size, revision) for p in sorted(Path(root).rglob("*.parquet"))]


def build_manifest(repo: str, entries: Iterable[Entry]) -> Manifest:
    """Entries in order of type, month and path; the order of the listing has no influence on the id."""
    return Manifest(repo, sorted(set(entries), key=lambda e: (e.record_type, e.month, e.path)))


def batches(entries: Iterable[Entry], most: int, most_bytes: int) -> list[list[Entry]]:
    """Parts of one type and month each, of at most ``most`` shards and, unless a single one is larger, ``most_bytes``."""
    out: list[list[Entry]] = []
    held = 0
    for e in entries:
        last = out[-1] if out else []
        same = bool(last) and (last[0].record_type, last[0].month) == (e.record_type, e.month)
        if same and len(last) < most and held + e.size <= most_bytes:
            last.append(e)
            held += e.size
        else:
            out.append([e])
            held = e.size
    return out


def write_json(path: str | Path, value: Any) -> None:
    """Written beside and renamed, so that a reader never sees half a file."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_suffix(path.suffix + ".tmp")
    beside.write_text(json.dumps(value, indent=2, sort_keys=True))
    os.replace(beside, path)


def read_json(path: str | Path) -> dict[str, Any] | None:
    path = Path(path)
    return json.loads(path.read_text()) if path.exists() else None


def digest(path: str | Path) -> str:
    """SHA-256 of a file, or of the names and digests of a folder's data files in order."""
    path = Path(path)
    if path.is_dir():
        files = sorted((p.name, digest(p)) for p in path.rglob("*") if p.is_file() and p.name[0] not in "._")
        return hashlib.sha256("".join(f"{name}:{d}\n" for name, d in files).encode()).hexdigest()
    total = hashlib.sha256()
    with path.open("rb") as data:
        while block := data.read(1 << 20):
            total.update(block)
    return total.hexdigest()


@dataclass
class Checkpoint:
    status: str
    manifest_id: str
    identity: str
    version: str
    config_hash: str
    rows_seen: int = 0
    rows_out: int = 0
    output: str = ""
    output_digest: str = ""

    def save(self, path: str | Path) -> None:
        write_json(path, asdict(self))


def reusable(path: str | Path, like: Checkpoint) -> Checkpoint | None:
    """The stored checkpoint if it is of the same work and its output is still what was written. A run without rows has no
    output to check."""
    raw = read_json(path)
    if not raw:
        return None
    old = Checkpoint(**raw)
    same = all(getattr(old, k) == getattr(like, k) for k in ("manifest_id", "identity", "version", "config_hash"))
    if not same or old.status not in ("completed", "completed_zero_rows"):
        return None
    if old.status == "completed_zero_rows":
        return old
    return old if Path(old.output).exists() and digest(old.output) == old.output_digest else None


def usable_output(path: str | Path) -> bool:
    """Whether a finished, non-empty result is there. An empty file is removed, so that it is made again."""
    path = Path(path)
    if path.is_dir():
        return (path / "_SUCCESS").exists()
    if path.exists() and path.stat().st_size == 0:
        path.unlink()
    return path.exists()


def run_record(path: str | Path, name: str, config_hash: str, **facts: Any) -> dict[str, Any]:
    record = {"run": name, "config_hash": config_hash, "finished_at": datetime.now(UTC).isoformat(), **facts}
    write_json(path, record)
    return record


def capacity(used_bytes: int, free_bytes: int, warn: int, stop: int, review: int, limit: int, least_free: int) -> dict[str, Any]:
    """The state of the store's size, and whether a new batch may begin."""
    steps = [(limit, "hard_limit"), (review, "retention_review"), (stop, "stop_widening"), (warn, "warning")]
    state = next((name for bound, name in steps if used_bytes >= bound), "healthy")
    return {"state": state, "used_bytes": used_bytes, "free_bytes": free_bytes, "can_start_new_batch": state in ("healthy", "warning") and free_bytes >= least_free}
