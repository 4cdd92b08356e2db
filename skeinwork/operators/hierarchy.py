"""Parent-child links to full hierarchies.

Subtree sizes are added upward, sibling preorder ranges come from prefix sums of these sizes and are added downward,
and the ranges ``[preorder, preorder + size)`` (nested sets) answer ancestor and descendant questions. Both passes
jump over 1, 2, 4, ... levels, so a chain of hundreds of levels takes about ten rounds and no task ever holds a tree.
Nodes that no number of jumps brings to a root are on a cycle or below one.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.ranged import run_positions
from skeinwork.scratch import materialize, release


def thread_parent(column: str) -> Column:
    """A parent reference without its kind prefix (``t1_``, ``t3_``, either case) and outer white space."""
    bare = F.regexp_replace(F.regexp_replace(F.col(column), r"^\s+|\s+$", ""), r"^[tT][0-9]_", "")
    return F.when(bare != "", bare)


class Hierarchy:
    """Trees over ``df[id, parent]``, both strings.

    * A null parent, or one that is no ``id`` of the table, makes the node a root.
    * Rows without an id are left out; of repeated ids the greatest non-null parent counts.
    * A node that is its own parent is a cycle of one.
    * An empty table gives empty results. Other columns of ``df`` are ignored, whatever their names.
    """

    def __init__(self, df: DataFrame, id: str = "source_id", parent: str = "parent_id"):
        rows = df.select(F.col(id).alias("id"), F.col(parent).alias("parent")).filter("id IS NOT NULL")
        rows = rows.groupBy("id").agg(F.max("parent").alias("parent"))
        known = rows.select(F.col("id").alias("known"))
        linked = rows.join(known, rows.parent == known.known, "left").select("id", F.col("known").alias("parent"))
        self.links = materialize(linked, "links")

    @cached_property
    def _upward(self) -> tuple[list[DataFrame], DataFrame]:
        """Contributions to subtree sizes by round, and the nodes that are never processed, with their far ancestors.

        Round k: ``jump`` is the ancestor 2^k levels up and ``s`` the number of nodes fewer than 2^k levels below a
        node, itself included. Depths below a root have no gaps, so a round that brings nobody to a root is the last.
        """
        active = self.links.filter("parent IS NOT NULL").select("id", F.col("parent").alias("jump"), F.lit(1).cast("long").alias("s"))
        gains: list[DataFrame] = []
        left, first = active.count(), True
        while left:
            gain = materialize(active.groupBy(F.col("jump").alias("id")).agg(F.sum("s").alias("gain")), "gain")
            up = active.select(F.col("id").alias("up"), F.col("jump").alias("far"))
            moved = active.join(up, F.col("jump") == F.col("up")).join(gain, "id", "left")
            after = materialize(moved.select("id", F.col("far").alias("jump"), (F.col("s") + F.coalesce("gain", F.lit(0))).alias("s")), "active")
            gains.append(gain)
            now = after.count()
            if not first:
                release(active)
            active, first = after, False
            if now == left:
                break
            left = now
        return gains, active

    @cached_property
    def cycles(self) -> DataFrame:
        """``id`` and ``cycle_id`` of every node whose chain of parents never ends; ``cycle_id`` is the smallest id on
        the loop the chain runs into, ``on_loop`` tells whether the node is part of it."""
        _, endless = self._upward
        far = endless.select("id", "jump")
        # images of ever longer jumps shrink until only the loops are left
        loop = materialize(far.select(F.col("jump").alias("id")).distinct(), "loop")
        size = loop.count()
        while size:
            up = far.select(F.col("id").alias("up"), F.col("jump").alias("next"))
            longer = materialize(far.join(up, F.col("jump") == F.col("up")).select("id", F.col("next").alias("jump")), "far")
            smaller = materialize(longer.select(F.col("jump").alias("id")).distinct(), "loop")
            release(loop, far)
            far, loop, before, size = longer, smaller, size, smaller.count()
            if size == before:
                break
        ring = self.links.join(loop, "id").select("id", F.col("parent").alias("jump"), F.col("id").alias("least"))
        ring = materialize(ring, "ring")
        while size:
            up = ring.select(F.col("id").alias("up"), F.col("jump").alias("next"), F.col("least").alias("other"))
            step = ring.join(up, F.col("jump") == F.col("up"))
            step = materialize(step.select("id", F.col("next").alias("jump"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("moved")), "ring")
            release(ring)
            ring = step
            if ring.filter("moved").isEmpty():
                break
        of = ring.select(F.col("id").alias("up"), F.col("least").alias("cycle_id"))
        on = loop.select(F.col("id").alias("member"))
        named = far.join(of, F.col("jump") == F.col("up")).join(on, F.col("id") == F.col("member"), "left")
        return named.select("id", "cycle_id", F.col("member").isNotNull().alias("on_loop"))

    @cached_property
    def sizes(self) -> DataFrame:
        """``id``, ``parent`` and ``size`` (nodes of the subtree, itself included) of the nodes of all trees."""
        gains, endless = self._upward
        trees = self.links.join(endless.select("id"), "id", "left_anti")
        if not gains:
            return trees.select("id", "parent", F.lit(1).cast("long").alias("size"))
        total = gains[0]
        for gain in gains[1:]:
            total = total.unionByName(gain)
        total = total.groupBy("id").agg(F.sum("gain").alias("gain"))
        return materialize(trees.join(total, "id", "left").select("id", "parent", (1 + F.coalesce("gain", F.lit(0))).alias("size")), "sizes")

    def nodes(self, with_path: bool = False) -> DataFrame:
        """``id, parent, root, depth, size, preorder`` of the nodes of all trees, roots at depth and preorder 0; siblings
        are in order of id. ``with_path`` adds the ids from the root to the node as an array."""
        sized = self.sizes
        inner = run_positions(sized.filter("parent IS NOT NULL"), ["parent"], [F.col("id").asc()], "size")
        path = [F.array("id").alias("path")] if with_path else []
        down = inner.select("id", "parent", "size", F.col("parent").alias("jump"), (F.col("prefix") + 1).alias("preorder"), F.lit(1).cast("long").alias("depth"), F.lit(None).cast("string").alias("root"), *path)
        roots = sized.filter("parent IS NULL").select("id", "parent", "size", F.lit(None).cast("string").alias("jump"), F.lit(0).cast("long").alias("preorder"), F.lit(0).cast("long").alias("depth"), F.col("id").alias("root"), *path)
        table = materialize(down.unionByName(roots), "down")
        while not table.filter("jump IS NOT NULL").isEmpty():
            up = table.select(*[F.col(c).alias(f"up_{c}") for c in ("id", "jump", "preorder", "depth", "root")], *([F.col("path").alias("up_path")] if with_path else []))
            moved = table.filter("jump IS NOT NULL").join(up, F.col("jump") == F.col("up_id")).select(
                "id", "parent", "size", F.col("up_jump").alias("jump"), (F.col("preorder") + F.col("up_preorder")).alias("preorder"),
                (F.col("depth") + F.col("up_depth")).alias("depth"), F.col("up_root").alias("root"), *([F.concat("up_path", "path").alias("path")] if with_path else []),
            )
            after = materialize(moved.unionByName(table.filter("jump IS NULL")), "down")
            release(table)
            table = after
        return table.select("id", "parent", "root", "depth", "size", "preorder", *(["path"] if with_path else []))


def descendants(nodes: DataFrame, width: int = 64) -> DataFrame:
    """``ancestor``, ``id`` for every node and each of its proper descendants, by nested sets, from ``nodes()``.

    Places in preorder are cut into bins of ``width``; a node meets, in the bin of its place, the ranges that reach into
    that bin. A range is sent to the bins it covers, so the work is that of the result and at most two bins a node more.
    The result is quadratic for chains; where ranges will do, ``preorder`` and ``size`` tell the same."""
    inner = nodes.filter("size > 1").select(F.col("id").alias("ancestor"), "root", F.col("preorder").alias("_from"), "size")
    ranges = inner.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("_from") + 1) / width), F.floor((F.col("_from") + F.col("size") - 1) / width))))
    places = nodes.filter("parent IS NOT NULL").select("id", "root", "preorder", F.floor(F.col("preorder") / width).alias("_bin"))
    met = places.join(ranges, ["root", "_bin"]).filter(is_descendant(F.col("preorder"), F.col("_from"), F.col("size"), F.lit(True)))
    return met.select("ancestor", "id")


def is_descendant(preorder: Column, of_preorder: Column, of_size: Column, same_root: Column) -> Column:
    """Whether a node lies below another, by nested sets."""
    return same_root & (preorder > of_preorder) & (preorder < of_preorder + of_size)
