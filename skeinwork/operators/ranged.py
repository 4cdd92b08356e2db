"""Positions and group statistics on a global range sort.

Rows are range-partitioned by key and secondary order with sampled quantiles, so a key that holds a third of all
rows is spread over as many partitions as its share asks for. Each partition is sorted and read once; what a
partition knows about its first and last key is carried over the boundaries afterwards. Only these boundary states,
one or two per partition, meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.scratch import materialize


#: bytes of rows, as Spark estimates them, to a range partition, and the most partitions
PARTITION_BYTES, MOST_PARTITIONS = 64 << 20, 100_000


def partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of ``df``: the session's number, and more where that would leave them large. The size is
    Spark's estimate, for joins (which it multiplies) at most some times what is read; rows from code have none."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    own, *read = [int(str(p.stats().sizeInBytes())) for p in (plan, *(leaves.apply(i) for i in range(leaves.size())))]
    size = min(own, 8 * sum(r for r in read if r < 1 << 60))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTITIONS, size // PARTITION_BYTES))


def _key_hash(keys: Sequence[str]) -> Column:
    """Equal for neighbours in sort order only if their keys are equal; nulls are told from values."""
    return F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))])


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None) -> DataFrame:
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    return df.repartitionByRange(n or partitions(df), *by).sortWithinPartitions(*by)


def run_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: str | None = None, n: int | None = None
) -> DataFrame:
    """``df`` with ``position`` (0-based, within the key in ``order``) and ``prefix`` (``weight`` of the rows before).

    ``order`` has to be total for a reproducible result; rows that tie in all of it are exchangeable. Without
    ``weight`` the prefix counts rows; a null weight counts as 0. Null keys form a key of their own. An empty table
    gives an empty result. The names position, prefix and those that begin with ``_sk_`` belong to the operator.
    """
    spark = df.sparkSession
    weight_col = F.coalesce(F.col(weight).cast("long"), F.lit(0)) if weight else F.lit(1).cast("long")
    source = df.withColumns({"_sk_k": _key_hash(keys), "_sk_w": weight_col})
    sorted_ = _ranged(source, keys, order, n)
    names = df.columns
    schema = T.StructType(
        [*df.schema.fields, *[T.StructField(c, T.LongType()) for c in ("_sk_k", "_sk_pid", "_sk_run", "_sk_pos", "_sk_pre", "_sk_w")]]
    )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        last, run, pos, pre = None, -1, 0, 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            k = batch.column("_sk_k").to_numpy(zero_copy_only=False)
            w = batch.column("_sk_w").to_numpy(zero_copy_only=False)
            new = np.empty(rows, bool)
            new[0] = last is None or k[0] != last
            new[1:] = k[1:] != k[:-1]
            runs = run + np.cumsum(new)
            index = np.arange(rows)
            start = np.maximum.accumulate(np.where(new, index, -1))
            before = np.cumsum(w) - w
            opened = start >= 0
            at = np.maximum(start, 0)
            positions = np.where(opened, index - at, pos + index)
            prefixes = np.where(opened, before - before[at], pre + before)
            last, run = k[-1], int(runs[-1])
            pos, pre = int(positions[-1]) + 1, int(prefixes[-1] + w[-1])
            extra = (k, np.full(rows, pid), runs, positions, prefixes, w)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *[pa.array(np.asarray(x, np.int64)) for x in extra]],
                names=[f.name for f in schema.fields],
            )

    table = materialize(sorted_.mapInArrow(local, schema), "runs")
    ends = F.max(F.struct("_sk_run", "_sk_pos", "_sk_k", "_sk_pre", "_sk_w"))
    first = F.max(F.when(F.col("_sk_run") == 0, F.col("_sk_k")))
    # one row per partition, whatever the number of rows
    states = sorted(table.groupBy("_sk_pid").agg(ends.alias("e"), first.alias("f")).collect(), key=lambda r: r["_sk_pid"])
    carry, key, count, total = [], None, 0, 0
    for s in states:
        e = s["e"]
        joins = key is not None and s["f"] == key
        if joins:
            carry.append((s["_sk_pid"], count, total))
        single = e["_sk_run"] == 0
        count = e["_sk_pos"] + 1 + (count if joins and single else 0)
        total = e["_sk_pre"] + e["_sk_w"] + (total if joins and single else 0)
        key = e["_sk_k"]
    carries = spark.createDataFrame(carry, "_sk_cp long, _sk_cc long, _sk_ct long")
    carried = table.join(F.broadcast(carries), (F.col("_sk_pid") == F.col("_sk_cp")) & (F.col("_sk_run") == 0), "left")
    return carried.select(
        *names,
        (F.col("_sk_pos") + F.coalesce("_sk_cc", F.lit(0))).alias("position"),
        (F.col("_sk_pre") + F.coalesce("_sk_ct", F.lit(0))).alias("prefix"),
    )


def run_states(df: DataFrame, keys: Sequence[str], value: str, flags: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """Per key: ``n_rows``, ``n_values`` (non-null), ``n_distinct``, the sums of ``flags`` (booleans or whole numbers), and
    ``low`` and ``high``, the two middle values (equal for an odd number; null without values).

    Exact for keys of any size. Rows of one key and value are counted before the sort, by partition and then together, so
    that any number of ties is one weighted row. Null keys form a key; a null flag counts as 0; an empty table gives no
    rows. Names that begin with ``_sk_`` belong to the operator.
    """
    flags = list(flags)
    rows = df.select(*keys, F.col(value).alias("_sk_v"), *[F.coalesce(F.col(f).cast("long"), F.lit(0)).alias(f) for f in flags])
    counted = rows.groupBy(*keys, "_sk_v").agg(F.count(F.lit(1)).alias("_sk_n"), *[F.sum(f).alias(f) for f in flags])
    sorted_ = _ranged(counted.withColumn("_sk_k", _key_hash(keys)), keys, [F.col("_sk_v").asc_nulls_last()], n or partitions(rows))
    vtype = df.schema[value].dataType
    numbers = ["_sk_pid", "_sk_run", "_sk_idx", "n_rows", "n_values", "n_distinct", *flags]
    schema = T.StructType(
        [T.StructField("_sk_edge", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in numbers], *[T.StructField(c, vtype) for c in ("low", "high")], *[T.StructField(k, df.schema[k].dataType) for k in keys]]
    )
    names = [f.name for f in schema.fields]

    def states(parts: list[pa.RecordBatch], pid: int, first: int, ends: bool) -> Iterator[pa.RecordBatch]:
        """Of whole runs, numbered from ``first`` on; with ``ends`` the last one may go on in the next partition."""
        table = pa.Table.from_batches(parts).combine_chunks()
        k, weight, v = table.column("_sk_k").to_numpy(), table.column("_sk_n").to_numpy(), pa.concat_arrays(table.column("_sk_v").chunks)
        start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        runs = start.size
        valid = v.is_valid().to_numpy(zero_copy_only=False)
        counts = np.where(valid, weight, 0)
        values, distinct = np.add.reduceat(counts, start), np.add.reduceat(valid.astype(np.int64), start)
        upto = np.cumsum(counts)
        base = upto[start] - counts[start]
        none = values == 0
        edge = np.zeros(runs, bool)
        edge[0], edge[-1] = first == 0, ends or (first == 0 and runs == 1)

        def at(place: np.ndarray) -> pa.Array:
            return v.take(pa.array(np.where(none, 0, np.searchsorted(upto, base + place, "right")), mask=none))

        last = np.maximum(values - 1, 0)
        number = [np.full(runs, pid), np.arange(first, first + runs), np.full(runs, -1), np.add.reduceat(weight, start), values, distinct]
        number += [np.add.reduceat(table.column(f).to_numpy(), start) for f in flags]
        columns = [pa.array(edge), *[pa.array(x, pa.int64()) for x in number], at(last // 2), at(np.minimum(values // 2, last))]
        yield pa.RecordBatch.from_arrays([*columns, *[pa.concat_arrays(table.column(c).chunks).take(pa.array(start)) for c in keys]], names=names)
        # the values of runs that may go on in a neighbouring partition: place and weight
        for r in np.flatnonzero(edge):
            for begin in range(int(start[r]), int(start[r] + distinct[r]), 65536):
                stop = min(begin + 65536, int(start[r] + distinct[r]))
                many = stop - begin
                cols = [np.full(many, pid), np.full(many, first + r), upto[begin:stop] - counts[begin:stop] - base[r], counts[begin:stop]]
                cols = [pa.nulls(many, pa.bool_()), *[pa.array(x, pa.int64()) for x in cols], *[pa.nulls(many, pa.int64())] * (2 + len(flags))]
                yield pa.RecordBatch.from_arrays([*cols, v.slice(begin, many), pa.nulls(many, v.type), *[pa.nulls(many, table.schema.field(c).type) for c in keys]], names=names)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # only the run that is not over yet is held
        pid = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        last, run = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("_sk_k").to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate(([last is not None and k[0] != last], k[1:] != k[:-1])))
            last = k[-1]
            if not new.size:
                held.append(batch)
                continue
            whole = [b for b in (*held, batch.slice(0, new[-1])) if b.num_rows]
            yield from states(whole, pid, run, False)
            run += new.size
            held = [batch.slice(new[-1])]
        if held:
            yield from states(held, pid, run, True)

    table = materialize(sorted_.mapInArrow(local, schema), "states")
    states_ = table.filter(F.col("_sk_idx") == -1)
    sums = ["n_rows", "n_values", "n_distinct", *flags]
    whole = states_.filter(~F.col("_sk_edge")).select(*keys, *sums, "low", "high")
    # at most two states per partition from here on
    by_key = Window.partitionBy(_key_hash(keys))
    before = F.sum("n_values").over(by_key.orderBy("_sk_pid", "_sk_run").rowsBetween(Window.unboundedPreceding, -1))
    edges = states_.filter("_sk_edge").withColumns({"_sk_before": F.coalesce(before, F.lit(0)), "_sk_total": F.sum("n_values").over(by_key)})
    stitched = edges.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    def middle(rank: Column, name: str) -> DataFrame:
        place = rank - F.col("_sk_before")
        spots = edges.filter((F.col("_sk_total") > 0) & (place >= 0) & (place < F.col("n_values"))).select(
            *[F.col(k).alias(f"_sk_key{i}") for i, k in enumerate(keys)], F.col("_sk_pid").alias("_sk_p"), F.col("_sk_run").alias("_sk_r"), place.alias("_sk_i")
        )
        values = table.filter(F.col("_sk_idx") >= 0).select("_sk_pid", "_sk_run", "_sk_idx", "n_rows", F.col("low").alias(name))
        # one spot per key that meets a boundary: at most two per partition
        inside = (F.col("_sk_i") >= F.col("_sk_idx")) & (F.col("_sk_i") < F.col("_sk_idx") + F.col("n_rows"))
        found = values.join(F.broadcast(spots), (F.col("_sk_pid") == F.col("_sk_p")) & (F.col("_sk_run") == F.col("_sk_r")) & inside)
        return found.select(*[F.col(f"_sk_key{i}") for i in range(len(keys))], name)

    for rank, name in ((F.floor((F.col("_sk_total") - 1) / 2), "low"), (F.floor(F.col("_sk_total") / 2), "high")):
        found = middle(rank, name)
        same_key = F.lit(True)
        for i, k in enumerate(keys):
            same_key = same_key & F.col(k).eqNullSafe(F.col(f"_sk_key{i}"))
        stitched = stitched.join(found, same_key, "left").drop(*[f"_sk_key{i}" for i in range(len(keys))])
    return whole.unionByName(stitched.select(*keys, *sums, "low", "high"))
