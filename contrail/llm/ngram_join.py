"""Operator 4, n-gram Jaccard join by prefix trees.

A document's set holds its distinct 5-word shingles. Two documents link when
their sets' Jaccard similarity reaches 0.8 (exact integer test). Steps:

1. Count all shingles of all documents into hash cells, more of them for
   more text (crowded cells tell rare shingles from common ones no more, and
   each set would meet in more and more blocks), up to a fixed number. Cells
   give the global order: rare cell first, hash second. A byte of each, its
   count's logarithm, is broadcast; it steers work, never results.
2. Equal sets become one set (128-bit content hash); the rest works on one
   document of each.
3. Prefix filter: two linked sets share a shingle among the first
   ``n - ceil(0.8 n) + 1`` of each in the global order. The sets that share
   such a shingle are taken by size and cut where the next size is too large
   for the one before; each run meets in the block named by its first set, so
   each linked pair meets in a block, and no pair is ever listed.
4. In a block the ordered sets are stored in a path-compressed trie. Each
   set walks it with the overlap gathered so far; a subtree is left when the
   lengths that remain cannot reach the needed overlap, or when all its sets
   are already in the walker's component.
5. A block of more than ``block_limit`` sets is split by a salt, its pivot in
   every part. Sets that did not join the pivot in their part then meet all
   parts in a second round. Nothing is dropped.
6. Links become components in Spark.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import (
    RangeHash, Words, batch_of, doc_id_of, identified, stored, text_chunks, texts_of,
)
from contrail.llm.components import components

WORDS = 5
PERCENT = 80
CELLS = 1 << 18      # at least
MOST_CELLS = 1 << 24  # of one byte in the broadcast table
CELL_BYTES = 200     # of text for each cell, some 30 shingles
BLOCK_LIMIT = 1_000
_PIECE, _MIDDLE = 1 << 16, 32  # cells of a piece of the table; partial sums of a piece
_AT_ONCE = 1 << 22   # shingles gathered before they are counted

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


@dataclass(frozen=True)
class Setting:
    words: int = WORDS
    percent: int = PERCENT
    cells: int | None = None  # by the size of the texts
    block_limit: int = BLOCK_LIMIT


def _sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct (text, shingle hash) as two arrays)."""
    w = Words(texts, fold=FOLD)
    rh = RangeHash(w.hash)
    room = np.where(w.counts >= k, w.counts - k + 1, np.minimum(w.counts, 1))
    doc = np.repeat(np.arange(len(texts)), room)
    start = w.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
    end = start + np.minimum(k, w.counts[doc])
    h = rh.of(start, end)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def with_cells(rows: DataFrame, setting: Setting) -> Setting:
    """``setting`` with the number of cells for the texts of ``rows``."""
    if setting.cells is not None:
        return setting
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    cells = CELLS
    while cells < MOST_CELLS and cells * CELL_BYTES < size:
        cells *= 2
    return replace(setting, cells=cells)


def _deflated(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, deflated."""
    width = 1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 8
    return bytes([width]) + zlib.compress(counts.astype(f"<u{width}").tobytes(), 1)


def _inflated(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(counts)[1:]), f"<u{counts[0]}").astype(np.int64)


def _count(setting: Setting):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some, size = np.zeros(setting.cells, dtype="<i8"), [], 0
        for _, texts in text_chunks(batches):
            _, h = _sets(texts, setting.words)
            some.append((h % np.uint64(setting.cells)).astype(np.int32))
            size += len(h)
            if size > _AT_ONCE:
                total += np.bincount(np.concatenate(some), minlength=setting.cells)
                some, size = [], 0
        if some:
            total += np.bincount(np.concatenate(some), minlength=setting.cells)
        middle = pa.array([TaskContext.get().partitionId() % _MIDDLE], pa.int32())
        for part, lo in enumerate(range(0, setting.cells, _PIECE)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), middle, pa.array(
                [_deflated(total[lo:lo + _PIECE])], pa.binary())], names=["part", "middle", "counts"])
    return run


def _summed(table: pa.Table) -> np.ndarray:
    return sum((_inflated(c.as_py()) for c in table["counts"]), start=np.int64(0))


def _total(key: tuple, table: pa.Table) -> pa.Table:
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([_deflated(_summed(table))], pa.binary())})


def _ranks(key: tuple, table: pa.Table) -> pa.Table:
    rank = np.minimum(8 * np.log2(1.0 + _summed(table)), 255).astype(np.uint8)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "ranks": pa.array([_deflated(rank)], pa.binary())})


def cell_ranks(rows: DataFrame, setting: Setting) -> np.ndarray:
    """A byte for each hash cell, that grows with the logarithm of the number
    of shingles in it over all documents. Each task sends its counts,
    deflated; they are added up piece by piece, in two levels in Spark."""
    parts = rows.mapInArrow(_count(setting), "part int, middle int, counts binary")
    half = parts.groupBy("part", "middle").applyInArrow(_total, "part int, counts binary")
    found = {r["part"]: r["ranks"] for r in half.groupBy("part").applyInArrow(_ranks, "part int, ranks binary").collect()}
    if not found:
        return np.zeros(setting.cells, dtype=np.uint8)
    return np.concatenate([_inflated(found[i]).astype(np.uint8) for i in range(len(found))])


_SUM = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()),
                  ("s2", pa.int64()), ("prefix", pa.list_(pa.int64()))])
_SUM_DDL = "_id long, _th long, n long, s1 long, s2 long, prefix array<long>"


def _prefixes(setting: Setting, cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cells.value
        for batch, texts in text_chunks(batches):
            doc, h = _sets(texts, setting.words)
            n = np.bincount(doc, minlength=len(texts))
            at = np.concatenate([[0], np.cumsum(n)])
            raw = h.tobytes()
            digest = [hashlib.blake2b(raw[8 * x:8 * y], digest_size=16).digest()
                      for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            s = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
            rank = counts[(h % np.uint64(setting.cells)).astype(np.int64)]
            order = np.lexsort((h, rank, doc))
            take = np.where(n > 0, n - (n * setting.percent + 99) // 100 + 1, 0)
            nth = np.arange(len(h)) - at[doc]
            keep = nth < take[doc]
            offsets = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[order][keep].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_th"), pa.array(n.astype(np.int64)),
                 pa.array(s[:, 0]), pa.array(s[:, 1]), prefix], schema=_SUM)
    return run


def _meet(percent: int):
    """Rows sorted by (token, size, set). The sets of a token are cut where
    a size is too large for the one before it; each set of a stretch meets
    the first one. Streams, so a popular token needs no memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = size = pivot = 0
        begun = False
        for b in batches:
            t, n, d = (b.column(c).to_numpy() for c in ("token", "n", "sid"))
            if not len(t):
                continue
            new = np.ones(len(t), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (100 * n[:-1] < percent * n[1:])
            new[0] = not begun or t[0] != token or 100 * size < percent * n[0]
            head = np.maximum.accumulate(np.where(new, np.arange(len(t)), -1))
            first = np.where(head >= 0, d[np.maximum(head, 0)], pivot)
            company = first[~new]
            # the pivot itself joins its block once it has company
            pair = np.unique(np.stack([np.concatenate([company, company]), np.concatenate([d[~new], company])]), axis=1)
            if pair.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["pivot", "sid"])
            token, size, pivot, begun = t[-1], n[-1], first[-1], True
    return run


class Trie:
    """Path-compressed trie of ascending integer sequences."""

    def __init__(self, seqs: list[np.ndarray]):
        self.seqs = seqs
        order = sorted(range(len(seqs)), key=lambda i: seqs[i].tolist())
        self.order = order
        # node: (segment, its end, children, ends here, low size, high size, members)
        self.top = self._build(0, len(order), 0)

    def _build(self, lo: int, hi: int, depth: int):
        seqs, order = self.seqs, self.order
        # an explicit stack: long chains of near copies would be too deep for recursion
        root: list = []
        todo = [(lo, hi, depth, root)]
        while todo:
            lo, hi, depth, into = todo.pop()
            if lo >= hi:
                continue
            a, b = seqs[order[lo]], seqs[order[hi - 1]]
            m = min(len(a), len(b))
            diff = np.flatnonzero(a[depth:m] != b[depth:m])
            end = depth + int(diff[0]) if len(diff) else m
            members = order[lo:hi]
            sizes = [len(seqs[i]) for i in members]
            stop = lo
            while stop < hi and len(seqs[order[stop]]) == end:
                stop += 1
            children: list = []
            into.append((a[depth:end], end, children, order[lo:stop], min(sizes), max(sizes), members))
            at = stop
            while at < hi:
                head = seqs[order[at]][end]
                nxt = at
                while nxt < hi and seqs[order[nxt]][end] == head:
                    nxt += 1
                todo.append((at, nxt, end, children))
                at = nxt
        return root


def linked(seqs: list[np.ndarray], percent: int, must: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links that connect what the similarity of all pairs connects.
    ``seqs``: ascending local numbers in the global order. ``must``: if
    given, only pairs with such a member are asked for."""
    n = len(seqs)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    width = 1 + max((int(s[-1]) for s in seqs if len(s)), default=0)
    trie = Trie(seqs)
    inside = np.zeros(width, dtype=bool)
    out = []
    for x in range(n):
        if must is not None and not must[x]:
            continue
        sx, mine = seqs[x], len(seqs[x])
        inside[sx] = True
        stack = [(node, 0) for node in trie.top]
        while stack:
            (segment, depth, children, here, low, high, members), shared = stack.pop()
            if 100 * mine < percent * low or 100 * high < percent * mine:
                continue  # all sizes too far away
            rx = root(x)
            if len(members) <= 64 and all(root(i) == rx for i in members):
                continue
            if len(segment):
                shared += int(np.count_nonzero(inside[segment]))
                left = mine - int(np.searchsorted(sx, segment[-1], side="right"))
            else:
                left = mine
            best = shared + min(left, high - depth)
            # percent * union <= 100 * best with union >= mine + low - best
            if (100 + percent) * best < percent * (mine + low):
                continue
            for y in here:
                if y != x and root(y) != rx and (100 + percent) * shared >= percent * (mine + len(seqs[y])):
                    parent[max(rx, root(y))] = min(rx, root(y))
                    rx = root(x)
                    out.append((x, y))
            stack += [(c, shared) for c in children]
        inside[sx] = False
    return out


_LINK_DDL = "a long, b long, pivot long, salt long, sid long, joined boolean"
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("pivot", pa.int64()), ("salt", pa.int64()),
                   ("sid", pa.int64()), ("joined", pa.bool_())])


def _blocks(setting: Setting, cells):
    """Rows sorted by (pivot, salt): the trie join of each block part."""
    def solve(block, ids, texts, asked, hot):
        doc, h = _sets(texts, setting.words)
        cell = cells.value[(h % np.uint64(setting.cells)).astype(np.int64)]
        distinct, first, local = np.unique(h, return_index=True, return_inverse=True)
        rank = np.empty(len(distinct), dtype=np.int64)
        rank[np.lexsort((distinct, cell[first]))] = np.arange(len(distinct))
        number = rank[local]
        order = np.lexsort((number, doc))
        at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
        seqs = [number[order[x:y]] for x, y in zip(at[:-1], at[1:], strict=True)]
        pairs = linked(seqs, setting.percent, asked)
        rows = [(ids[x], ids[y], None, None, None, None) for x, y in pairs]
        if hot:  # which sets are in the pivot's component
            reach, grow = {ids.index(block[0])} if block[0] in ids else set(), True
            while grow:
                grow = False
                for x, y in pairs:
                    if (x in reach) != (y in reach):
                        reach |= {x, y}
                        grow = True
            rows += [(None, None, *block, i, n in reach) for n, i in enumerate(ids)]
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, asked, hot = None, [], [], [], False
        rows: list[tuple] = []
        for b in batches:
            body = texts_of(b.column("text"))
            for p, s, i, m, x, t in zip(*(b.column(c).to_pylist() for c in ("pivot", "salt", "sid", "must", "hot")),
                                        body, strict=True):
                if (p, s) != block:
                    if ids:
                        rows += solve(block, ids, texts, asked if any(asked) else None, hot)
                    block, ids, texts, asked = (p, s), [], [], []
                    if len(rows) > 10_000:
                        yield batch_of(_LINK, **dict(zip(_LINK.names, zip(*rows, strict=True), strict=True)))
                        rows = []
                if i not in ids[-1:]:
                    ids.append(i)
                    texts.append(t)
                    asked.append(m)
                    hot = x
        if ids:
            rows += solve(block, ids, texts, asked if any(asked) else None, hot)
        if rows:
            yield batch_of(_LINK, **dict(zip(_LINK.names, zip(*rows, strict=True), strict=True)))
    return run


def set_links(docs: DataFrame, setting: Setting = Setting()) -> tuple[DataFrame, DataFrame]:
    """(sets, links): ``_id, _th, n, sid, rep`` of every row, where ``sid``
    names the set and ``rep`` is the least id that has it (both null for
    empty sets), and links (a, b) of different sets that connect what
    similarity connects."""
    rows = identified(docs)
    setting = with_cells(rows, setting)
    cells = docs.sparkSession.sparkContext.broadcast(cell_ranks(rows, setting))
    made = stored(rows.mapInArrow(_prefixes(setting, cells), _SUM_DDL), "sets")
    reps = stored(made.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("_id", "_th")).alias("r"))
                  .select("s1", "s2", "n", "r"), "reps")
    sets = made.select("_id", "_th", "n", "s1", "s2").join(
        reps.select("s1", "s2", "n", F.col("s1").alias("sid"), F.col("r._id").alias("rep")),
        ["s1", "s2", "n"], "left").select("_id", "_th", "n", "sid", "rep")
    chosen = reps.select(F.col("s1").alias("sid"), "r._id", "r._th")
    tokens = (made.select("_id", "_th", "n", "prefix").join(chosen, ["_id", "_th"])
              .select("sid", "n", F.explode("prefix").alias("token"))
              .repartition("token").sortWithinPartitions("token", "n", "sid"))
    members = stored(tokens.mapInArrow(_meet(setting.percent), "pivot long, sid long").distinct(), "members")
    size = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("c"))
    dealt = members.join(size, "pivot").withColumn("parts", F.ceil(F.col("c") / setting.block_limit))
    hot = F.col("parts") > 1
    salts = F.when(hot & (F.col("sid") == F.col("pivot")), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)) \
             .otherwise(F.array(F.pmod(F.xxhash64("sid"), F.col("parts"))))
    where = dealt.select("sid", F.struct("pivot", "parts", hot.alias("hot"), salts.alias("salts")).alias("x"))
    lists = where.groupBy("sid").agg(F.collect_list("x").alias("xs")).join(chosen, "sid")
    texts = stored(rows.join(lists, ["_id", "_th"]).dropDuplicates(["_id", "_th"]).select("sid", "text", "xs"), "blocks")
    blocks = (texts.select("sid", "text", F.explode("xs").alias("x"))
              .select("sid", "text", "x.pivot", "x.parts", "x.hot", F.explode("x.salts").alias("salt"))
              .withColumn("must", F.lit(False)))

    def joined(part: DataFrame) -> DataFrame:
        return (part.repartition(F.col("pivot"), F.col("salt")).sortWithinPartitions("pivot", "salt", "sid")
                .mapInArrow(_blocks(setting, cells), _LINK_DDL))

    first = stored(joined(blocks), "links")
    links = first.filter("a IS NOT NULL").select("a", "b")
    left = first.filter("a IS NULL AND NOT joined AND sid <> pivot").select("pivot", "sid")
    if not left.isEmpty():
        # second round: each remaining set meets every part of its block, in chunks of bounded size
        chunks = left.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / setting.block_limit).alias("chunks"))
        again = blocks.join(chunks, "pivot")
        hosts = again.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        guests = (again.join(left, ["pivot", "sid"], "left_semi")
                  .withColumn("must", F.lit(True))
                  .withColumn("chunk", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("chunks")))
                  .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
        both = hosts.unionByName(guests.select(hosts.columns))
        # a guest that is also a host of the part counts once, as a guest
        both = both.groupBy("pivot", "salt", "chunk", "sid").agg(
            F.max("must").alias("must"), F.first("text").alias("text"))
        both = both.select("pivot", (F.col("salt") * F.lit(1 << 24) + F.col("chunk")).alias("salt"), "sid", "text",
                           F.lit(False).alias("hot"), "must")
        links = links.unionByName(joined(both).select("a", "b"))
    return sets, links


def set_groups(docs: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """``_id, _th, n, group`` of every row: rows of linked or equal sets
    share the group, whatever their ids; null for empty sets."""
    sets, links = set_links(docs, setting)
    comp = components(links).withColumnRenamed("node", "sid")
    return sets.join(comp, "sid", "left").select("_id", "_th", "n", F.coalesce("comp", "sid").alias("group"))


def ngram_components(docs: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """``_id, _th, n, component`` of every row, see :func:`ngram_groups`."""
    sets, links = set_links(docs, setting)
    comp = components(links)
    least = (sets.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("rep").alias("rep"))
             .join(comp.withColumnRenamed("node", "sid"), "sid")
             .groupBy("comp").agg(F.min("rep").alias("component")))
    named = comp.join(least, "comp").select(F.col("node").alias("sid"), "component")
    return sets.join(named, "sid", "left").select(
        "_id", "_th", "n", F.coalesce("component", "rep", "_id").alias("component"))


def ngram_groups(docs: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (``doc_id``,
    ``text``; other columns are ignored, whatever their names).

    Texts are folded A-Z to a-z and cut at spaces and \\t..\\r. Fewer than
    five words: the whole sequence is the one shingle; none, or null: the
    empty set, linked with nothing. component_id is the smallest doc_id
    reachable by links, the row's own included. Repeated rows are copies. A
    null doc_id is read as the largest long."""
    return ngram_components(docs, setting).select(
        doc_id_of(), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
