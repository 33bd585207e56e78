"""Operator 5, mixing sources to target weights by a splitting tree.

Documents are dealt by hash to ``blocks`` blocks per source. A source's
target is met by whole passes over its blocks and a part of one more pass,
which takes the blocks in a permuted order; where the target ends inside a
block, its documents are taken in hash order, the last one in part. So the
number of block draws of each source is exact.

The draws are then split over the output shards: from the root down, each
node of a binary tree hands its left half a multivariate-hypergeometric
share of its per-source draws, so every shard holds a fair sample of the
mixture and the shards together hold exactly the quotas. A shard takes the
next draws of each source's permuted order; draws are disjoint by
construction; ``place``, a hash, orders the rows of a shard.

Only one row per source reaches the driver: the mixture itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import doc_id_of, identity, stored, with_plain_names, without_columns

BLOCKS = 2048
SHARDS = 16
SEED = 20240101
LIMIT = 3             # a source, and a document, is used at most so many times
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[int], limit: int = LIMIT) -> list[float]:
    """Shares of the total by weight; what exceeds ``limit`` times a
    source's size is shared again by weight among the others."""
    out = [0.0] * len(sizes)
    open_, rest = list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / total > limit * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / total
            break
        for i in over:
            out[i] = float(limit * sizes[i])
        rest -= sum(limit * sizes[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Draws of each source (columns) for each shard (rows)."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    n = int(quotas.sum()) * left // shards
    mine = rng.multivariate_hypergeometric(quotas, n, method="marginals") if n else np.zeros_like(quotas)
    return np.concatenate([split(mine, left, rng), split(quotas - mine, shards - left, rng)])


def _hash(seed: int, *cols):
    return F.xxhash64(F.lit(seed), *cols)


def mixed(docs: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``_id, _th, size, source_size, target, taken, shards`` of every row of
    ``docs`` (doc_id, text, source). ``shards`` lists the output shard of
    each copy: whole ones first, then one in part."""
    spark = docs.sparkSession
    rows = stored(docs.select(
        *identity(docs), docs["source"].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(_WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    rows = rows.withColumn("block", F.pmod(_hash(seed, "_id", "_th"), F.lit(blocks)))
    per_block = stored(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    found = per_block.groupBy("source").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n")).collect()
    if not found:
        return rows.select("_id", "_th", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"),
                           F.col("size").alias("taken"), F.array().cast("array<int>").alias("shards"))
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    target = targets([r["words"] for r in found], [i % 3 + 1 for i in range(len(found))])
    plan = []
    for i, (r, t) in enumerate(zip(found, target, strict=True)):
        goal = min(round(t), LIMIT * r["words"])
        passes = goal // r["words"] if r["words"] else 0
        plan.append((i, r["source"], r["words"], float(t), passes, goal - passes * r["words"], r["n"]))
    mix = spark.createDataFrame(
        plan, "s int, source string, source_size long, target double, passes long, part long, n long")
    # permuted order of a source's blocks, and where the partial pass ends
    order = Window.partitionBy("s").orderBy(_hash(seed + 1, "s", "block"), "block")
    placed = (per_block.join(F.broadcast(mix), per_block["source"].eqNullSafe(mix["source"]))
              .select("s", "block", "words", "source_size", "target", "passes", "part", "n",
                      (F.row_number().over(order) - 1).alias("nth"),
                      (F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("before")))
    placed = stored(placed.withColumn("room", F.greatest(F.lit(0), F.least("words", F.col("part") - F.col("before")))),
                    "placed")
    used = {r["s"]: r["c"] for r in placed.filter("room > 0").groupBy("s").agg(F.count(F.lit(1)).alias("c")).collect()}
    quotas = np.array([p[4] * p[6] + used.get(p[0], 0) for p in plan], dtype=np.int64)
    tree = split(quotas, shards, np.random.default_rng(seed))
    ends = np.cumsum(tree, axis=0)
    cuts = spark.createDataFrame([(i, [int(x) for x in ends[:, i]]) for i in range(len(plan))], "s int, ends array<long>")

    def shard(draw):
        return F.size(F.filter("ends", lambda e: e <= draw)).cast("int")

    whole = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1),
                                                    lambda p: shard(p * F.col("n") + F.col("nth"))))
    part = F.when(F.col("room") > 0, F.array(shard(F.col("passes") * F.col("n") + F.col("nth"))))
    none = F.array().cast("array<int>")
    known = placed.join(F.broadcast(cuts), "s").select(
        "s", "block", "words", "source_size", "target", "passes", "room",
        F.coalesce(whole, none).alias("whole"), F.coalesce(part, none).alias("partial"))
    names = F.broadcast(mix.select("s", "source"))
    dealt = rows.join(names, rows["source"].eqNullSafe(names["source"])).select(
        "_id", "_th", "size", "s", "block").join(known, ["s", "block"])
    # whole blocks, untouched blocks, and the one block of each source where its target ends
    ends_here = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    inside = Window.partitionBy("s").orderBy(_hash(seed + 2, "_id", "_th"), "_id", "_th")
    cut = dealt.filter(ends_here).withColumn(
        "extra", F.greatest(F.lit(0), F.least("size", F.col("room") - (
            F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")))))
    rest = dealt.filter(~ends_here).withColumn("extra", F.when(F.col("room") > 0, F.col("size")).otherwise(F.lit(0)))
    return cut.unionByName(rest).select(
        "_id", "_th", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        F.when((F.col("extra") > 0) | ((F.col("size") == 0) & ~ends_here), F.concat("whole", "partial"))
        .otherwise(F.col("whole")).alias("shards"))


def mix_sizes(docs: DataFrame, **setting) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards of every row.

    Null text has size 0; null source is a source of its own, the last.
    Repeated rows are separate documents, equal in all columns but for the
    one row where a target may end. An empty table gives no rows; further
    columns of ``docs`` are ignored, whatever their names. Same input, same
    result."""
    return mixed(docs, **setting).select(doc_id_of(), "size", "source_size", "target", "taken", "shards")


def mixture(docs: DataFrame, seed: int = SEED, **setting) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` and ``copy``, ``words``,
    ``shard``, ``place`` (a hash; the order inside the shard), one row per
    copy. A copy in part holds the first ``words`` words of its text.

    Rows without words and null sources take part as :func:`mix_sizes` says;
    of exactly repeated rows each is mixed for itself. An empty table gives no
    rows. Input columns named like the four added ones are left out, others
    are kept, whatever their names."""
    docs = without_columns(docs, ("copy", "words", "shard", "place"))

    def mix(d: DataFrame) -> DataFrame:
        plan = mixed(d, seed=seed, **setting).dropDuplicates(["_id", "_th"]).select("_id", "_th", "size", "taken", "shards")
        rows = d.select(*[d[c] for c in d.columns], *identity(d))
        one = rows.join(plan, ["_id", "_th"]).select(*d.columns, "_id", "_th", "size", "taken",
                                                     F.posexplode("shards").alias("copy", "shard"))
        words = F.least("size", F.col("taken") - F.col("copy") * F.col("size"))
        out = one.withColumn("words", words).withColumn("place", _hash(seed + 3, "_id", "_th", "copy"))
        short = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({_WORD})")), 1, F.col("words").cast("int")), " ")
        cols = [F.when(F.col("words") < F.col("size"), short).otherwise(F.col("text")).alias("text") if c == "text"
                else F.col(c) for c in d.columns]
        return out.select(*cols, "copy", "words", "shard", "place")
    return with_plain_names(docs, mix)
