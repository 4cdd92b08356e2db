"""Near-duplicate records with small edits: an exact similarity self-join of word-sequence sets.

Texts with equal sets form a class; classes are compared.

1. All sets are counted into a sketch of a fixed number of counters. It gives one global order of word sequences, rare
   ones first. The order decides about cost only: any order gives the same result.
2. Two sets that agree enough share a sequence among the first ones of both in that order (prefix filter). Sets that
   share one meet in a tile, sorted by size, in which a set meets only the band of sizes that may agree with its own.
   Sequences that very many texts hold make no tiles: sets that have nothing rarer in common share two of them. Tiles of
   many sets are cut into blocks, and pairs of blocks whose sizes are too far apart are never formed.
3. In a tile, the bits in which two bitmap signatures differ bound the overlap from above. What passes is compared by
   exact intersection of the sorted arrays.

No pair that reaches the limit is lost, no tile or number of partners is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm.joining import attach
from skeinwork.llm.pairs import pairs_within
from skeinwork.llm.shingles import ODD, STEP, Sets, mixed, shingle_sets
from skeinwork.operators.ranged import partitions
from skeinwork.scratch import materialize

CHUNKS = 64
SIGNATURE = 6  # 64-bit words
#: a set in a tile
ENTRY = np.dtype([("id", "<i8"), ("sig", "<u8", SIGNATURE), ("size", "<i4"), ("index", "?")])
#: postings of a block of sets: the sets with their number of sequences in the bucket, and these sequences, set by set:
#: 47 upper bits of each, and a bit that tells whether it belongs to the shorter prefix
BLOCK_SET = np.dtype([("id", "<i8"), ("sig", "<u8", SIGNATURE), ("size", "<i4"), ("many", "<u4")])
BLOCK_KEY = np.dtype([("high", "<u4"), ("low", "<u2")])
TILE = 8192
#: counted so often, a sequence makes no tile by itself
HEAVY = 4096
#: word sequences of the corpus to a bucket; a part of them, those of the prefixes, is sent there
SEQUENCES = 8_000_000
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Limit:
    """``agreement`` (Jaccard) at least this fraction."""

    value: Fraction

    def probe(self, size: np.ndarray) -> np.ndarray:
        """Sequences to look at in a set, for partners that are not larger."""
        return size - -(-size * self.value.numerator // self.value.denominator) + 1

    def index(self, size: np.ndarray) -> np.ndarray:
        """The same for partners that are not smaller."""
        n, d = 2 * self.value.numerator, self.value.numerator + self.value.denominator
        return size - -(-size * n // d) + 1

    def overlap(self, sizes: np.ndarray) -> np.ndarray:
        """Common sequences needed by two sets of ``sizes`` in sum."""
        n, d = self.value.numerator, self.value.numerator + self.value.denominator
        return -(-sizes * n // d)

    def near(self, smaller: np.ndarray, larger: np.ndarray) -> np.ndarray:
        return smaller.astype(np.int64) * self.value.denominator >= larger.astype(np.int64) * self.value.numerator


def _texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP):
            part = batch.slice(start, STEP)
            yield part, part.column(text).to_pylist()


def _class_ids(sets: Sets) -> tuple[np.ndarray, pa.Array]:
    """128 bits of each set as its identity, and the first 64 of them, by which postings name it."""
    if not sets.rows.size:
        return np.empty(0, np.int64), pa.array([], pa.binary())
    both = np.empty((sets.rows.size, 2), "<u8")
    for i, seed in enumerate((np.uint64(0), ODD)):
        both[:, i] = mixed(np.add.reduceat(mixed(sets.values ^ seed) | np.uint64(1), sets.offsets[:-1]))
    return both[:, 0].astype(np.uint64).view(np.int64), pa.Array.from_buffers(pa.binary(16), sets.rows.size, [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())


def _pair_keys(values: np.ndarray, probe: int, index: int, heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of two sequences each, for a set whose sequences ``values`` are in order and heavy from place ``heavy`` on, and
    whether they are keys of the shorter prefix. Sets that share no light sequence of their prefixes share two heavy ones
    of the prefixes that are longer by one, so heavy sequences need no tiles of their own."""
    first, second = np.triu_indices(min(probe + 1, values.size) - heavy, 1)
    first, second = first + heavy, second + heavy
    return mixed((values[first] * ODD) ^ mixed(values[second])), (first < index) & (second < index + 1)


def _signatures(sets: Sets) -> np.ndarray:
    """Parity bitmaps: sets that differ in ``d`` sequences differ in at most ``d`` bits."""
    bits = (sets.values % np.uint64(64 * SIGNATURE)).astype(np.int64)
    one = np.uint64(1) << (bits % 64).astype(np.uint64)
    out = np.empty((sets.rows.size, SIGNATURE), np.uint64)
    for word in range(SIGNATURE):
        out[:, word] = np.bitwise_xor.reduceat(np.where(bits // 64 == word, one, np.uint64(0)), sets.offsets[:-1]) if sets.rows.size else 0
    return out


def _rank(count: np.ndarray) -> np.ndarray:
    return np.where(count < 2, count, np.minimum(255, 2 + 8 * np.log2(np.maximum(count, 2) / 2))).astype(np.uint8)


def _sketch(docs: DataFrame, text: str, width: int, min_words: int, bits: int) -> tuple[bytes, int]:
    """The number of word sequences in all sets, and a sketch of them: for each of ``2 ** bits`` counters, the count of the word sequences that fall to it, as a rank of one byte: 0 and 1
    as they are, larger ones on a logarithmic scale. Of fixed size, whatever the size of the corpus."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for _, texts in _texts(batches, text):
            sets = shingle_sets(texts, width, min_words)
            places, many = np.unique(sets.values >> np.uint64(64 - bits), return_counts=True)
            total[places.astype(np.int64)] += many.astype(np.uint32)
        blobs = [c.astype("<u2").tobytes() if c.max() < 65536 else c.astype("<u4").tobytes() for c in np.split(total, CHUNKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(blob, "<u2" if len(blob) == 2 * size // CHUNKS else "<u4").astype(np.uint64)
                total[chunk] = total[chunk] + counts if chunk in total else counts
        ranks = [_rank(c).tobytes() for c in total.values()]
        sums = [int(c.sum()) for c in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(ranks, pa.binary()), pa.array(sums, pa.int64())], names=["chunk", "counts", "total"])

    schema = "chunk int, counts binary"
    parts = docs.select(text).mapInArrow(count, schema).repartition(min(CHUNKS, partitions(docs)), "chunk")
    found = {r["chunk"]: r for r in parts.mapInArrow(add, f"{schema}, total long").collect()}
    ranks = b"".join(bytes(found[i]["counts"]) if i in found else bytes(size // CHUNKS) for i in range(CHUNKS))
    return ranks, sum(r["total"] for r in found.values())


def _compare(left: np.ndarray, right: np.ndarray, limit: Limit) -> np.ndarray:
    """Whether pairs of entries, the left not the larger, may agree enough: by size, then by differing bits."""
    differing = np.bitwise_count(left["sig"] ^ right["sig"]).sum(axis=1)
    sizes = left["size"].astype(np.int64) + right["size"]
    return (differing <= sizes - 2 * limit.overlap(sizes)) & limit.near(left["size"], right["size"])


def _pairs_of_tiles(entries: np.ndarray, tile: np.ndarray, limit: Limit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the pairs within tiles; ``tile`` numbers, in order, the tile of each entry. Tiles are sorted by size, and an
    entry meets the band of sizes from which a set may agree with it enough, up to its own."""
    size = entries["size"].astype(np.int64)
    place = (tile.astype(np.int64) << 32) | size
    start = np.searchsorted(place, (tile.astype(np.int64) << 32) | -(-size * limit.value.numerator // limit.value.denominator))
    earlier = np.arange(entries.size) - start
    upto = np.cumsum(earlier)
    at = 0
    while at < entries.size:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, "right")))
        counts = earlier[at:stop]
        right = np.repeat(np.arange(at, stop), counts)
        left = np.arange(right.size) - np.repeat(np.cumsum(counts) - counts, counts) + start[right]
        fit = entries["index"][left] & (entries["id"][left] != entries["id"][right])
        left, right = left[fit], right[fit]
        fit = _compare(entries[left], entries[right], limit)
        yield entries["id"][left[fit]], entries["id"][right[fit]]
        at = stop


def _entries(known: np.ndarray, owner: np.ndarray, flag: np.ndarray) -> np.ndarray:
    entries = np.empty(owner.size, ENTRY)
    for name in ("id", "sig", "size"):
        entries[name] = known[name][owner]
    entries["index"] = flag
    return entries


def _candidates(blocks: DataFrame, limit: Limit, n: int) -> tuple[DataFrame, DataFrame]:
    """Identifiers with their classes, and pairs of short class names that may agree enough."""
    names = ["id", "class", "a", "b", "left", "right"]
    schema = "id string, class binary, a long, b long, left binary, right binary"

    def batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(a.size, pa.binary())
        return pa.RecordBatch.from_arrays([pa.nulls(a.size, pa.string()), none, pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), none, none], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, keys, of, index, n_sets = [], [], [], [], 0
        for rows in batches:
            member = rows.column("class").is_valid()
            of_texts = rows.filter(member)
            if of_texts.num_rows:
                many = of_texts.num_rows
                none = pa.nulls(many, pa.binary())
                yield pa.RecordBatch.from_arrays([of_texts.column("id"), of_texts.column("class"), of_texts.column("short"), pa.nulls(many, pa.int64()), none, none], names=names)
            rows = rows.filter(pc.invert(member))
            for set_blob, key_blob in zip(rows.column("sets"), rows.column("keys")):
                s, k = np.frombuffer(set_blob.as_buffer(), BLOCK_SET), np.frombuffer(key_blob.as_buffer(), BLOCK_KEY)
                sets.append(s)
                packed = (k["high"].astype(np.uint64) << np.uint64(16)) | k["low"]
                keys.append(packed >> np.uint64(1))
                index.append((packed & np.uint64(1)) > 0)
                of.append(np.repeat(np.arange(n_sets, n_sets + s.size), s["many"]))
                n_sets += s.size
        if not keys:
            return
        known, all_keys, owners, flags = np.concatenate(sets), np.concatenate(keys), np.concatenate(of), np.concatenate(index)
        del sets, keys, of, index
        # tiles are made for a slice of the keys at a time, so that what is unpacked stays small
        slices = -(-all_keys.size // AT_ONCE)
        for part in range(slices):
            chosen = np.flatnonzero(all_keys % np.uint64(slices) == part)
            key, owner, flag = all_keys[chosen], owners[chosen], flags[chosen]
            order = np.lexsort((known["id"][owner], known["size"][owner], key))
            key, owner, flag = key[order], owner[order], flag[order]
            # repeated rows of a class count once, keys of one class belong to no pair
            again = np.zeros(key.size, bool)
            again[1:] = (key[1:] == key[:-1]) & (known["id"][owner[1:]] == known["id"][owner[:-1]])
            key, owner, flag = key[~again], owner[~again], flag[~again]
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else np.empty(0, np.int64)
            many = np.diff(np.append(begin, key.size))
            small = (many > 1) & (many <= TILE)
            shared = np.repeat(small, many)
            entries = _entries(known, owner[shared], flag[shared])
            for a, b in _pairs_of_tiles(entries, np.repeat(np.arange(int(small.sum())), many[small]), limit):
                if a.size:
                    yield batch(a, b)
            for first, length in zip(begin[many > TILE], many[many > TILE]):
                cuts = [_entries(known, owner[i : (stop := min(i + TILE, first + length))], flag[i:stop]) for i in range(first, first + length, TILE)]
                for j, right in enumerate(cuts):
                    for left in cuts[: j + 1]:
                        if limit.near(left["size"][-1:], right["size"][:1])[0]:
                            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * 2, *[pa.array([x.tobytes()], pa.binary()) for x in (left, right)]], names=names)

    def blocks_of_heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for x, y in zip(rows.column("left"), rows.column("right")):
                left, right = np.frombuffer(x.as_buffer(), ENTRY), np.frombuffer(y.as_buffer(), ENTRY)
                same = x == y
                for i in range(0, right.size, 64):
                    part = right[i : i + 64]
                    l, r = np.tile(np.arange(left.size), part.size), np.repeat(np.arange(part.size), left.size)
                    fit = left["index"][l] & (left["id"][l] != part["id"][r])
                    if same:
                        fit &= l < r + i
                    l, r = l[fit], r[fit]
                    fit = _compare(left[l], part[r], limit)
                    if fit.any():
                        yield batch(left["id"][l[fit]], part["id"][r[fit]])

    met = materialize(blocks.repartition(n, "bucket").mapInArrow(meet, schema), "tiles")
    heavy = met.filter("left IS NOT NULL").repartition(n).mapInArrow(blocks_of_heavy, schema)
    pairs = met.filter("b IS NOT NULL").select("a", "b").unionByName(heavy.select("a", "b")).distinct()
    members = met.filter("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("class", F.col("a").alias("short"))).alias("c")).select("id", "c.class", "c.short")
    return materialize(members, "members"), materialize(pairs, "candidates")


def _labels(spark: SparkSession, n: int) -> np.ndarray:
    """Numbers that ``repartition(n, ...)`` sends to ``n`` different partitions, so that buckets don't share one."""
    tried = spark.range(n * (12 + n.bit_length())).select(F.col("id").cast("int").alias("label"))
    placed = tried.groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("part")).agg(F.min("label").alias("label"))
    found = [r["label"] for r in placed.orderBy("part").collect()]
    return np.array([found[i % len(found)] for i in range(n)], np.int32)


@dataclass
class NearDuplicates:
    """``members``: identifier and ``class`` (one per distinct set, identified by 128 bits of it) of every text that is
    long enough. ``links``: pairs of classes ``a, b`` that agree enough, with their ``agreement``."""

    members: DataFrame
    links: DataFrame
    identifier: str

    def pairs(self) -> DataFrame:
        """``<identifier>_a`` < ``<identifier>_b``: all pairs of records, exact copies included."""
        name, tile = self.identifier, 5000
        within = pairs_within(self.members, "class", name)
        sizes = self.members.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_t"))
        placed = self.members.join(sizes, "class").withColumn("_p", F.pmod(F.xxhash64(name), F.col("_t")).cast("int"))

        def side(links: DataFrame, end: str, out: str) -> DataFrame:
            of = sizes.select(F.col("class").alias(end), "_t")
            parts = links.join(of, end).withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_t") - 1))).drop("_t")
            return parts.join(placed.select(F.col("class").alias(end), "_p", F.col(name).alias(out)), [end, "_p"]).drop("_p", end)

        across = side(side(self.links.select("a", "b"), "a", "_x"), "b", "_y")
        ordered = across.select(F.least("_x", "_y").alias(f"{name}_a"), F.greatest("_x", "_y").alias(f"{name}_b"))
        return within.unionByName(ordered)

    def classes(self) -> DataFrame:
        """One row per record: ``class_id`` (the smallest identifier of its class) and ``n_links``, the number of other
        classes that its class agrees with."""
        ends = self.links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
        heads = self.members.groupBy("class").agg(F.min(self.identifier).alias("class_id")).join(ends, "class", "left")
        heads = heads.select("class", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        return self.members.join(heads, "class").select(self.identifier, "class_id", "n_links")


def near_duplicates(
    docs: DataFrame, identifier: str, text: str, agreement: float = 0.8, width: int = 5, min_words: int = 0, sketch_bits: int = 22
) -> NearDuplicates:
    """Texts of ``docs`` whose sets of ``width``-word sequences have a Jaccard similarity of at least ``agreement``.

    Words are the runs of a-z and 0-9 in the lower-cased text. Null identifiers, null texts and texts of fewer than
    ``min_words`` or ``width`` words are left out. Rows that repeat an identifier are taken to repeat its text. An
    empty table gives empty results; other columns are ignored.
    """
    limit = Limit(Fraction(str(agreement)))
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    sketch, total = _sketch(rows, "text", width, min_words, sketch_bits)
    ranks = spark.sparkContext.broadcast(sketch)  # 2 ** sketch_bits bytes
    n = max(6, total // SEQUENCES)
    # a tile of a sequence that stands out from what a counter holds anyway would be large
    heavy = int(_rank(np.array([max(HEAVY, 4 * total >> sketch_bits)]))[0])
    labels = _labels(spark, n)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(ranks.value, np.uint8)
        held: list[tuple[np.ndarray, ...]] = []
        held_sets = 0
        names = ["id", "class", "short", "bucket", "sets", "keys"]

        def blocks() -> pa.RecordBatch:
            sets = np.concatenate([h[0] for h in held])
            # keys of two sequences follow the sets they are of and count back from their end
            base = np.cumsum([0, *[h[0].size for h in held[:-1]]])
            key = np.concatenate([h[1] for h in held])
            owner = np.concatenate([h[2] + b for h, b in zip(held, base)])
            flag = np.concatenate([h[3] for h in held])
            bucket = (key % np.uint64(n)).astype(np.int64)
            order = np.lexsort((owner, bucket))
            key, owner, flag, bucket = key[order], owner[order], flag[order], bucket[order]
            found, begin = np.unique(bucket, return_index=True)
            set_blobs, key_blobs = [], []
            for b, e in zip(begin, np.append(begin[1:], key.size)):
                own, counts = np.unique(owner[b:e], return_counts=True)
                bits = (key[b:e] >> np.uint64(17) << np.uint64(1)) | flag[b:e].astype(np.uint64)
                packed = np.empty(e - b, BLOCK_KEY)
                packed["high"], packed["low"] = bits >> np.uint64(16), bits & np.uint64(0xFFFF)
                listed = sets[own]
                listed["many"] = counts
                set_blobs.append(listed.tobytes())
                key_blobs.append(packed.tobytes())
            many = found.size
            return pa.RecordBatch.from_arrays(
                [pa.nulls(many, pa.string()), pa.nulls(many, pa.binary()), pa.nulls(many, pa.int64()), pa.array(labels[found]), pa.array(set_blobs, pa.binary()), pa.array(key_blobs, pa.binary())],
                names=names,
            )

        for part, texts in _texts(batches, "text"):
            sets = shingle_sets(texts, width, min_words)
            if not sets.rows.size:
                continue
            (ids, classes), size = _class_ids(sets), np.diff(sets.offsets)
            none = pa.nulls(ids.size, pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(sets.rows)).cast(pa.string()), classes, pa.array(ids), pa.array(labels[np.abs(ids % n)]), none, none], names=names)
            owner = np.repeat(np.arange(size.size), size)
            frequency = rank[(sets.values >> np.uint64(64 - sketch_bits)).astype(np.int64)]
            # rare first, then by value: the row number keeps the order of values within a set
            code = (owner.astype(np.uint64) << np.uint64(52)) | (frequency.astype(np.uint64) << np.uint64(44)) | np.arange(owner.size, dtype=np.uint64)
            order = (np.sort(code) & np.uint64((1 << 44) - 1)).astype(np.int64)
            place = np.arange(owner.size) - np.repeat(sets.offsets[:-1], size)
            # a sequence that was counted once is in one text only
            probe, shorter = limit.probe(size), limit.index(size)
            ranks_in_order = frequency[order]
            is_heavy = ranks_in_order >= heavy
            # two common sequences are sure only where more than one is asked for
            alone = ~is_heavy | np.repeat(size - probe + 1 < 2, size)
            use = (place < np.repeat(probe, size)) & (ranks_in_order > 1) & alone
            chosen = order[use]
            entry = np.empty(size.size, BLOCK_SET)
            entry["id"], entry["sig"], entry["size"] = ids, _signatures(sets), size
            held.append((entry, sets.values[chosen], owner[use], (place < np.repeat(shorter, size))[use]))
            light = np.add.reduceat((~is_heavy).astype(np.int64), sets.offsets[:-1])
            for i in np.flatnonzero(light < probe):
                b, e = sets.offsets[i], sets.offsets[i + 1]
                pair_keys, short = _pair_keys(sets.values[order[b:e]], int(probe[i]), int(shorter[i]), int(light[i]))
                held.append((entry[:0], pair_keys, np.full(pair_keys.size, i - size.size), short))
            held_sets += size.size
            if held_sets > 20_000:
                yield blocks()
                held, held_sets = [], 0
        if held:
            yield blocks()

    posted = rows.mapInArrow(post, "id string, class binary, short long, bucket int, sets binary, keys binary")
    members, candidates = _candidates(posted, limit, n)
    links = _verify(rows, members, candidates, limit, width, min_words)
    # classes are told apart by all of their bits from here on
    return NearDuplicates(members.select(F.col("id").cast(docs.schema[identifier].dataType).alias(identifier), "class"), links, identifier)


def equal_words(docs: DataFrame, identifier: str, text: str) -> DataFrame:
    """One row per record, as ``classes()`` gives them, for texts that are too short for sequences: texts of the same words
    in the same order are a class, without links. Words are the runs of letters and digits of any script in the
    lower-cased text; texts without words, such as emoji, are compared as they are but for outer spaces. A null text is a
    class by itself, as nothing is known of it. Rows without identifier are left out, repeated identifiers count once."""
    rows = docs.select(F.col(identifier), F.col(text).alias("_text")).filter(F.col(identifier).isNotNull()).groupBy(identifier).agg(F.min("_text").alias("_text"))
    words = F.array_join(F.regexp_extract_all(F.lower("_text"), F.lit(r"([\p{L}\p{M}\p{N}]+)"), F.lit(1)), " ")
    rows = rows.withColumn("_key", F.when(words != "", F.concat(F.lit("w"), words)).otherwise(F.concat(F.lit("t"), F.trim("_text"))))
    rows = materialize(rows.select(identifier, F.sha2(F.coalesce("_key", F.concat(F.lit("n"), F.col(identifier).cast("string"))), 256).alias("_key")), "short")
    # a heavy text such as [deleted] has one row here for all its records
    heads = rows.groupBy("_key").agg(F.min(identifier).alias("class_id"), F.count(F.lit(1)).alias("_n"))
    out = attach(rows.select(identifier, "_key"), heads, ["_key"], identifier, heads.count(), "_n")
    return out.select(identifier, "class_id", F.lit(0).cast("long").alias("n_links"))


def _verify(rows: DataFrame, members: DataFrame, candidates: DataFrame, limit: Limit, width: int, min_words: int) -> DataFrame:
    """The candidates that agree enough, by exact intersection of their sets."""
    several = members.groupBy("short").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("short")
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("short")).unionByName(several).distinct()
    heads = materialize(members.join(wanted, "short").groupBy("class", "short").agg(F.min("id").alias("head")), "heads")
    many = heads.count()
    texts = attach(rows.withColumn("head", F.col("id").cast("string")), heads, ["head"], "id", many).select("class", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _texts(batches, "text"):
            got = shingle_sets(found, width, min_words)
            blobs = [got.values[b:e].tobytes() for b, e in zip(got.offsets[:-1], got.offsets[1:])]
            yield pa.RecordBatch.from_arrays([part.column("class").take(pa.array(got.rows)), pa.array(blobs, pa.binary())], names=["class", "members"])

    arrays = materialize(texts.mapInArrow(sets, "class binary, members binary").dropDuplicates(["class"]), "arrays")
    names = heads.select("class", "short")
    named = candidates.join(names.toDF("ca", "a"), "a").join(names.toDF("cb", "b"), "b").select("ca", "cb")
    # different classes of one short name are candidates too: none to be expected below some 10^9 classes
    again = names.join(several, "short")
    again = again.toDF("short", "ca").join(again.toDF("short", "cb"), "short").filter("ca < cb").select("ca", "cb")
    pairs = named.unionByName(again).toDF("a", "b")
    both = pairs.join(arrays.select(F.col("class").alias("a"), F.col("members").alias("left")), "a")
    both = both.join(arrays.select(F.col("class").alias("b"), F.col("members").alias("right")), "b")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = np.empty(batch.num_rows)
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"))):
                left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate((left, right)), kind="stable")
                common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                whole = left.size + right.size - common
                shares[i] = common / whole if common * limit.value.denominator >= whole * limit.value.numerator else -1
            ok = pa.array(shares >= 0)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok), pa.array(shares).filter(ok)], names=["a", "b", "agreement"])

    return materialize(both.select("a", "b", "left", "right").mapInArrow(intersect, "a binary, b binary, agreement double"), "links")


__all__ = ["NearDuplicates", "equal_words", "near_duplicates"]
