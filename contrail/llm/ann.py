"""Operator 3, approximate nearest neighbours on shifted Hilbert curves.

Equal vectors are one point that lists its smallest ids. The points are
projected to ``dims`` dimensions by several random orthonormal projections,
shifted, quantised and put on a Hilbert curve. Spark range-partitions each
ordering by key (equal keys stay in order by point); counts per partition
give every point its place. A query looks at the ``reach`` of all places
before and after its own on each curve; places are dealt in blocks, the
query goes to every block its window touches, the blocks return their
nearest, and the lists of all windows merge by exact distance. The queries
of a block are dealt in chunks of about ``chunk``, each with the block's
points, so a task holds a bounded table however many queries there are.

``reach`` is a share of the points. Where near points share few directions
(vectors spread evenly in many dimensions) no curve keeps neighbours
together and the share must be large; the default holds recall above 0.9 on
such data. Set it far lower for data of low intrinsic dimension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stored
from contrail.session import ship_code

K = 10
CURVES = 3
DIMS, BITS = 6, 10
REACH = 0.3           # of all points, on each side
BLOCK = 4_096         # places a task compares at once
CHUNK = 4_096         # queries a task compares with a block, about
SAMPLE = 2_000        # vectors that set the range of the grid


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Keys of integer points (n, d) on the Hilbert curve: Gray-code
    transposition, all points at once."""
    x = x.astype(np.int64).copy()
    d = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _on_curves(turns, low, high, shifts, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"))
            for c, turn in enumerate(turns):
                y = (v @ turn - low[c]) / np.maximum(high[c] - low[c], 1e-12)
                grid = np.clip((0.5 * y + shifts[c] + 0.05) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), c, dtype=np.int32)), pa.array(hilbert_keys(grid, bits)), b.column("point")],
                    names=["curve", "key", "point"])
    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds partition and place in it."""
    part, n = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("curve"), b.column("point"), pa.array(np.full(b.num_rows, part, dtype=np.int32)),
             pa.array(np.arange(n, n + b.num_rows, dtype=np.int64))], names=["curve", "point", "part", "at"])
        n += b.num_rows


def places(points: DataFrame, curves: int, dims: int, bits: int, seed: int) -> DataFrame:
    """(curve, place, point): the order of all points on each curve."""
    some = [r["v"] for r in points.orderBy(F.xxhash64("point")).limit(SAMPLE).select("v").collect()]
    x = np.array(some, dtype=np.float64)
    r = np.random.default_rng(seed)
    width = x.shape[1]
    d = min(dims, width)
    turns = [np.linalg.qr(r.normal(size=(width, d)))[0] for _ in range(curves)]
    low, high = [(x @ t).min(0) for t in turns], [(x @ t).max(0) for t in turns]
    shifts = [r.uniform(0, 0.4, d) for _ in turns]
    keyed = points.select("point", "v").mapInArrow(_on_curves(turns, low, high, shifts, bits),
                                                   "curve int, key long, point long")
    ordered = keyed.repartitionByRange("curve", "key", "point").sortWithinPartitions("curve", "key", "point")
    rows = stored(ordered.mapInArrow(_number, "curve int, point long, part int, at long"), "curve")
    # one row per partition and curve
    sizes = rows.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = sizes.withColumn("before", F.sum("n").over(
        Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return rows.join(F.broadcast(before), ["curve", "part"]).select(
        "curve", "point", (F.coalesce("before", F.lit(0)) + F.col("at") - F.col("first")).alias("place"))


def _nearest(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """The nearest points of one block for each query sent to it."""
        ask = table["ask"].to_numpy()
        q, c = table.filter(pa.array(ask)), table.filter(pa.array(~ask))
        out = []
        if len(q) and len(c):
            cv = _matrix(c["v"].combine_chunks())
            place = c["place"].to_numpy()
            points = c["point"].to_numpy()
            for lo in range(0, len(q), 64):
                part = q.slice(lo, 64)
                qv = _matrix(part["v"].combine_chunks())
                dist = ((qv * qv).sum(1)[:, None] - 2 * qv @ cv.T + (cv * cv).sum(1)[None]).clip(0)
                dist[(place[None] < part["low"].to_numpy()[:, None]) | (place[None] > part["high"].to_numpy()[:, None])] = np.inf
                # a few more than k by the fast form of the distance; the exact one decides
                most = min(k + 8, dist.shape[1])
                near = np.argpartition(dist, most - 1, axis=1)[:, :most]
                for i, name in enumerate(part["point"].to_numpy()):
                    pick = near[i][np.isfinite(dist[i, near[i]])]
                    exact = np.sqrt(((cv[pick] - qv[i]) ** 2).sum(1))
                    out.append((np.full(len(pick), name), points[pick], exact))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"q": pa.array(cols[0], pa.int64()), "point": pa.array(cols[1], pa.int64()),
                         "dist": pa.array(cols[2], pa.float64())})
    return run


def dealt(spots: DataFrame, asked: DataFrame, total: int, span: int, chunk: int = CHUNK) -> DataFrame:
    """Queries (``ask``) and points by the group (curve, block, chunk) they
    meet in. ``spots``: point, curve, place, v; ``asked``: point, each once."""
    chunks = max(1, -(-asked.count() // chunk))
    blocks = spots.withColumn("block", F.floor(F.col("place") / BLOCK)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    low, high = F.greatest(F.lit(0), F.col("place") - span), F.least(F.lit(total - 1), F.col("place") + span)
    who = spots.join(asked, "point", "left_semi").withColumn("chunk", F.pmod(F.xxhash64("point"), F.lit(chunks).cast("long")))
    sent = who.withColumns({"low": low, "high": high}).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK))))
    cols = ["curve", "block", "chunk", "point", "place", "v", "low", "high", "ask"]
    return sent.withColumn("ask", F.lit(True)).select(cols).unionByName(
        blocks.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(0).cast("long"), "ask": F.lit(False)}).select(cols))


def nearest_neighbours(vectors: DataFrame, k: int = K, every: int = 100, curves: int = CURVES, dims: int = DIMS,
                       bits: int = BITS, reach: float = REACH, seed: int = 17, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the ``k`` nearest
    found for each row whose vec_id is divisible by ``every``. ``vectors``:
    vec_id, embedding (array of one length).

    Vectors that are null, of zero length, zero, or hold null or non-finite
    components take no part, nor do rows with a null id, nor vectors of
    another length than the commonest. Ties go to the smaller id; repeated
    rows of an id count once. Fewer candidates than ``k``: all of them.
    Further columns are ignored, whatever their names."""
    ship_code()
    v = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v"))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)
                 & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    widths = v.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not widths:
        return empty
    v = v.filter(F.size("v") == widths[0]["w"]).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    ids = v.select("vec_id", "v").dropDuplicates(["vec_id"])
    # one point per distinct vector: its smallest id names it; k + 1 ids answer any query
    named = stored(ids.withColumn("hash", F.xxhash64("v")), "vectors")
    order = Window.partitionBy("hash", "v").orderBy("vec_id")
    head = named.groupBy("hash", "v").agg(F.min("vec_id").alias("point"))
    points = stored(head.select("point", "v"), "points")
    few = named.join(points.select(F.col("point").alias("vec_id")), "vec_id", "left_anti")
    listed = (few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
              .join(head, ["hash", "v"]).select("point", "vec_id")
              .unionByName(points.select("point", F.col("point").alias("vec_id"))))
    asked = named.filter(F.col("vec_id") % every == 0).join(head, ["hash", "v"]).select("vec_id", "point")
    spots = stored(places(points, curves, dims, bits, seed).join(points, "point"), "places")
    total = points.count()
    span = max(int(total * reach), 8 * k)
    both = dealt(spots, asked.select("point").distinct(), total, span, chunk)
    found = both.groupBy("curve", "block", "chunk").applyInArrow(_nearest(k), "q long, point long, dist double")
    merged = found.groupBy("q", "point").agg(F.min("dist").alias("score"))
    # the nearest k + 1 points hold the nearest k ids of any query of the point
    best = merged.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("score", "point"))).filter(
        F.col("r") <= k + 1)
    pairs = (best.join(listed, "point").join(asked.select(F.col("vec_id").alias("query_id"), F.col("point").alias("q")), "q")
             .filter(F.col("vec_id") != F.col("query_id")))
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
