"""Row-wise stages over arriving files, in resumable micro-batches. The stages are stateless maps; deduplication belongs to
the batch layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def run_available(spark: SparkSession, source: str, schema: T.StructType, stage: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Takes the files of ``source`` that were not taken before, through ``stage``, to Parquet in ``sink``; ends when done."""
    rows = spark.readStream.schema(schema).parquet(source)
    query = stage(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
