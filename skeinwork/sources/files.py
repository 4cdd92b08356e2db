"""Files of any file system that Spark knows: what executors wrote is seen, moved and removed where it is."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


class Files:
    """The file system through Hadoop's interface; paths are text, without a scheme those of the default file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def _at(self, path: str) -> tuple[Any, Any]:
        target = self._path(str(path))
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, folder: str) -> list[str]:
        """What is in a folder, in order; nothing for one that is not there."""
        fs, target = self._at(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []

    def move(self, path: str, to: str) -> None:
        """To a place that is free."""
        fs, source = self._at(path)
        target = self._path(str(to))
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(source, target):
            raise OSError(f"could not move {path} to {to}")

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def read_json(self, path: str) -> dict[str, Any] | None:
        fs, target = self._at(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def write_json(self, path: str, value: Any) -> None:
        """Written beside and renamed, so that a reader never sees half a file; one that is there is replaced."""
        fs, target = self._at(path)
        beside = self._path(f"{path}.tmp-{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        stream.write(bytearray(json.dumps(value, indent=2, sort_keys=True).encode()))
        stream.close()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"could not write {path}")

    def digest(self, path: str) -> str:
        """As ``manifest.digest``, read by the executors: SHA-256 of a file, or of the names and digests of a folder's files."""
        fs, target = self._at(path)
        rows = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(path)).select("path", F.sha2("content", 256).alias("d"))
        parts = sorted((r["path"].rpartition("/")[2], r["d"]) for r in rows.collect())
        if not fs.getFileStatus(target).isDirectory():
            return parts[0][1]
        return hashlib.sha256("".join(f"{name}:{d}\n" for name, d in parts if name[0] not in "._").encode()).hexdigest()
