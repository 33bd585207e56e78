"""Operator 11, sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks. A row goes down from
the root: at every node each child draws ``-ln(u) / weight``, ``u`` a hash
of the row's key and the child in (0, 1), and the least draw wins. A child's
weight is the sum of its shards' weights, so a shard gets its share of the
rows, and a draw depends on the key and that child only. When weights
change, a row therefore moves only where a child on its way has another
weight than before: subtrees whose weights are the same exchange no rows.

A further shard opens a region of its own (:meth:`Tree.grown`). No other
node's weight changes, so rows move into the new shard only.

Placing a row is a row-local expression, without shuffle. Slots inside a
shard are counts: equal rows become one row with its number, shards are cut
into hash buckets, and running sums over bucket counts, then inside a bucket,
give every group of equal rows its first slot.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stored

SEED = 20240611
BUCKET_ROWS = 100_000  # rows of one task that numbers slots
COPY_ROWS = 10_000     # equal rows that one row is unfolded to at a time


@dataclass(frozen=True)
class Tree:
    """Leaves ``(region, rack, shard, weight)``; numbers of regions are
    unique, of racks inside a region, of shards in the tree. Leaves of weight
    0 take no rows; negative weights and a tree without weight are errors."""

    leaves: tuple[tuple[int, int, int, float], ...]

    def __post_init__(self):
        if any(w < 0 for *_, w in self.leaves) or not any(w > 0 for *_, w in self.leaves):
            raise ValueError("weights must not be negative, and one must be over 0")
        if len({s for _, _, s, _ in self.leaves}) < len(self.leaves):
            raise ValueError("a shard stands in the tree twice")

    @staticmethod
    def of(shards: int, racks: int = 2, per_rack: int = 2) -> Tree:
        """``shards`` leaves of weight 1, ``racks`` racks of ``per_rack``
        shards in a region; the last region may be smaller."""
        return Tree(tuple((s // (racks * per_rack), s // per_rack % racks, s, 1.0) for s in range(shards)))

    def grown(self, weight: float = 1.0) -> Tree:
        """With one shard more, in a region of its own."""
        region, shard = max(r for r, *_ in self.leaves) + 1, max(s for _, _, s, _ in self.leaves) + 1
        return Tree((*self.leaves, (region, 0, shard, weight)))

    def weighing(self, shard: int, weight: float) -> Tree:
        """With another weight of one shard."""
        return Tree(tuple((r, k, s, weight if s == shard else w) for r, k, s, w in self.leaves))

    def levels(self) -> list[list[list[tuple[int, float]]]]:
        """For each level the children ``(number, weight)`` of its parents;
        the parents of a level are the children of the one above, in order."""
        alive = sorted(x for x in self.leaves if x[3] > 0)
        parents: list[tuple] = [()]
        out = []
        for depth in (1, 2, 3):
            weights: dict[tuple, float] = {}
            for leaf in alive:
                weights[leaf[:depth]] = weights.get(leaf[:depth], 0.0) + leaf[3]
            out.append([[(p[-1], w) for p, w in weights.items() if p[:-1] == up] for up in parents])
            parents = list(weights)
        return out


def _nodes(children: Iterable[list[tuple[int, float]]]) -> Column:
    """The children of every parent, with their place among all of the level."""
    out, at = [], 0
    for family in children:
        out.append(F.array(*[F.struct(F.lit(at + i).alias("at"), F.lit(n).alias("n"), F.lit(float(w)).alias("w"))
                             for i, (n, w) in enumerate(family)]))
        at += len(family)
    return F.array(*out)


def _drawn(path: Column, family: Column) -> Column:
    """(draw, place, number) of the child that wins; ties to the first."""
    def draw(child):
        bits = F.shiftrightunsigned(F.xxhash64(path, child["n"]), 11).cast("double")
        return F.struct((-F.ln((bits + 0.5) / float(1 << 53)) / child["w"]).alias("draw"),
                        child["at"].alias("at"), child["n"].alias("n"))
    return F.array_min(F.transform(family, draw))


def placed(rows: DataFrame, key: Column, tree: Tree, prefix: str = "", seed: int = SEED) -> DataFrame:
    """``rows`` with ``region``, ``rack`` and ``shard`` (names prefixed) by
    ``key``. A null key is a key like any other."""
    top, middle, low = tree.levels()
    names = [prefix + n for n in ("region", "rack", "shard")]
    # a child's draw hashes the key with the numbers on the way down to it
    rows = rows.withColumn(names[0], _drawn(F.xxhash64(F.lit(seed), key), _nodes(top)[0]))
    region = F.col(names[0])
    rows = rows.withColumn(names[1], _drawn(F.xxhash64(F.lit(seed + 1), key, region["n"]),
                                            F.get(_nodes(middle), region["at"])))
    rack = F.col(names[1])
    rows = rows.withColumn(names[2], _drawn(F.xxhash64(F.lit(seed + 2), key, region["n"], rack["n"]),
                                            F.get(_nodes(low), rack["at"])))
    return rows.withColumns({n: F.col(n)["n"].cast("int") for n in names})


def sharded(docs: DataFrame, tree: Tree, seed: int = SEED) -> DataFrame:
    """(doc, region, rack, shard) of every row: ``doc`` holds all columns of
    the row, whatever their names. Rows with one ``doc_id`` share a shard;
    a null id is an id of its own. Nothing is shuffled; written with
    ``partitionBy("shard")``, every shard is a folder."""
    doc = F.struct(*[docs[c].alias(c) for c in docs.columns])
    return placed(docs.select(doc.alias("doc")), F.col("doc")["doc_id"].cast("long"), tree, seed=seed)


def numbered(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, copy_rows: int = COPY_ROWS) -> DataFrame:
    """``rows`` (with ``shard``) and ``slot``: 0, 1, ... inside a shard.
    Equal rows get consecutive slots. No task numbers more than about
    ``bucket_rows`` different rows, or unfolds more than ``copy_rows`` copies
    of one at a time; columns must be comparable."""
    cols = rows.columns
    same = stored(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")), "same-rows")
    buckets = -(-max(1, same.count()) // bucket_rows)
    same = same.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED + 3), *cols), F.lit(buckets)))
    sums = same.groupBy("shard", "bucket").agg(F.sum("copies").alias("held"))
    before = Window.partitionBy("shard").orderBy("bucket")
    starts = sums.select("shard", "bucket", (F.sum("held").over(before) - F.col("held")).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy(*cols)
    first = same.join(starts, ["shard", "bucket"]).withColumn(
        "first", F.col("start") + F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))
    part = first.select(*cols, "first", "copies", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(copy_rows).cast("long"))).alias("from"))
    part = part.repartition("shard", F.col("first") + F.col("from"))
    return part.select(*cols, F.explode(F.sequence(
        F.col("first") + F.col("from"),
        F.col("first") + F.least("copies", F.col("from") + copy_rows) - 1)).alias("slot"))


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack
    of every row of ``docs`` (doc_id, text), under the law ``key``.

    ``size`` is the text's UTF-8 bytes plus 1. A null text counts as empty
    (size 1, CRC 0). ``grown_shard`` is the shard with one shard more: the same
    or the new one. Repeated ids share a shard, equal rows differ in ``slot``
    only. An empty table gives no rows; other columns are ignored, whatever
    their names. Same input, same result."""
    tree = Tree.of(shards)
    text = F.coalesce(docs["text"].cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = placed(rows, F.col("doc_id"), tree, seed=seed)
    rows = placed(rows, F.col("doc_id"), tree.grown(), "grown_", seed=seed)
    out = numbered(rows.drop("grown_region", "grown_rack"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "region", "rack")
