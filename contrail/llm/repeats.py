"""Where do long stretches of text repeat? The shared dataflow of the word
and the byte form of exact substring removal.

A window is ``window`` consecutive items (words or bytes) of one text. All
texts cannot meet all texts, so windows are first dealt by content: the
least hash of the ``gram``-item runs inside a window is its key. Equal
windows have equal keys, whatever surrounds them. Neighbouring windows of
one key form a stretch; a key that turns up once cannot repeat, so its
stretches go no further. The others are cut out of their texts and dealt to
shards by key, where a matcher (suffix automaton or suffix array) decides
window by window.

A key with more than ``group_limit`` stretches is split into several
shards by a salt. Inside each, the matcher works as always; the windows it
leaves open there are then compared across the shards, by a 128-bit content
hash (words) or dealt once more by a longer run (bytes, see
:mod:`contrail.llm.suffix_dedup`). No stretch is dropped, whatever the size
of the group.

Three tables go to the shared checkpoint folder: the stretches of all
texts, the texts that have candidates, and what the matchers found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import (
    RangeHash, Words, batch_of, byte_values, identified, merged_runs, sliding_min, stored, text_chunks,
    texts_of,
)

GROUP_LIMIT = 2_000  # stretches of one key in one shard

_SCAN = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("key", pa.int64()), ("a", pa.int64()),
                   ("b", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_SCAN_DDL = "_id long, _th long, key long, a long, b long, n long, digest string"
_CUT = pa.schema([("key", pa.int64()), ("salt", pa.int64()), ("hot", pa.bool_()), ("_id", pa.int64()),
                  ("_th", pa.int64()), ("a", pa.int64()), ("body", pa.binary())])
_CUT_DDL = "key long, salt long, hot boolean, _id long, _th long, a long, body binary"
_FOUND = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("s", pa.int64()), ("e", pa.int64()),
                    ("w1", pa.int64()), ("w2", pa.int64()), ("body", pa.binary())])
_FOUND_DDL = "_id long, _th long, s long, e long, w1 long, w2 long, body binary"
_PIECE = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("key", pa.int64()), ("a", pa.int64()),
                    ("body", pa.binary())])
_PIECE_DDL = "_id long, _th long, key long, a long, body binary"
_KEPT = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("n_removed", pa.int64()),
                   ("n_spans", pa.int64()), ("kept", pa.binary())])
_KEPT_DDL = "_id long, _th long, n_removed long, n_spans long, kept binary"


@dataclass(frozen=True)
class Rule:
    """``words``: items are words, else bytes. ``across``: only a place in
    another document with a smaller id counts; else any other place does."""

    window: int
    gram: int
    words: bool
    across: bool
    match: Callable  # (distinct stretches, shard) -> found rows, see the operators
    shard_items: int
    group_limit: int = GROUP_LIMIT
    pieces: bool = False  # open windows of split keys go on as pieces of text, not one by one


def _items(texts: list[bytes], rule: Rule):
    """(hashes of all runs of ``gram`` items, first item of each text)."""
    if rule.words:
        w = Words(texts)
        return RangeHash(w.hash).grams(rule.gram) if len(w.hash) >= rule.gram else w.hash[:0], w.first
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    grams = RangeHash(byte_values()[buf]).grams(rule.gram) if len(buf) >= rule.gram else np.zeros(0, np.uint64)
    return grams, first


def _stretches(grams: np.ndarray, first: np.ndarray, rule: Rule):
    """Text, place in it and key of each window that lies inside one text,
    and the first and last window of each stretch of one key."""
    least = sliding_min(grams, rule.window - rule.gram + 1)
    room = np.maximum(np.diff(first) - rule.window + 1, 0)
    doc = np.repeat(np.arange(len(room)), room)
    offset = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
    keys = least[first[doc] + offset]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc, offset, keys, at, np.append(at[1:], len(doc)) - 1


def _split(rule: Rule):
    """The stretches of pieces of text, with their content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in text_chunks([whole.rename_columns(["_id", "_th", "s", "text"])]):
                grams, first = _items(texts, rule)
                doc, offset, keys, at, last = _stretches(grams, first, rule)
                if len(at):
                    who, lo = doc[at], offset[at]
                    yield batch_of(_PIECE, _id=batch.column("_id").to_numpy()[who],
                                   _th=batch.column("_th").to_numpy()[who], key=keys[at].view(np.int64),
                                   a=batch.column("s").to_numpy()[who] + lo,
                                   body=[texts[d][x:y + rule.window] for d, x, y
                                         in zip(who.tolist(), lo.tolist(), offset[last].tolist(), strict=True)])
    return run


def _scan(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            ids = batch.column("_id").to_numpy()
            ths = batch.column("_th").to_numpy()
            grams, first = _items(texts, rule)
            n = np.diff(first)
            digests = [hashlib.sha256(b" ".join(t.split()) if rule.words else t).hexdigest() for t in texts]
            none = [None] * len(texts)
            yield batch_of(_SCAN, _id=ids, _th=ths, key=none, a=none, b=none, n=n, digest=digests)
            doc, offset, keys, at, last = _stretches(grams, first, rule)
            if not len(doc):
                continue
            times = np.ones(len(at), dtype=np.int64)
            if not rule.across:  # a stretch can repeat in itself only if its least run turns up twice in it
                lo = (first[doc[at]] + offset[at]).tolist()
                hi = (first[doc[at]] + offset[last] + rule.window - rule.gram + 1).tolist()
                times[:] = [np.count_nonzero(grams[x:y] == v) for x, y, v in zip(lo, hi, keys[at], strict=True)]
            yield batch_of(_SCAN, _id=ids[doc[at]], _th=ths[doc[at]], key=keys[at].view(np.int64),
                           a=offset[at], b=offset[last], n=times, digest=[None] * len(at))
    return run


def _cut(rule: Rule):
    """The stretches of each text with candidates, with their content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            rows: list[tuple] = []
            size = 0
            for i, (t, spots) in enumerate(zip(texts, batch.column("spots"), strict=True)):
                items = t.split() if rule.words else t
                who = batch.column("_id")[i].as_py(), batch.column("_th")[i].as_py()
                for x in spots.as_py():
                    part = items[x["a"]:x["b"] + rule.window]
                    body = b" ".join(part) if rule.words else part
                    rows.append((x["key"], x["salt"], x["hot"], *who, x["a"], body))
                    size += len(body)
                if size > 4 << 20:
                    yield _rows(_CUT, rows)
                    rows, size = [], 0
            if rows:
                yield _rows(_CUT, rows)
    return run


class Shard:
    """Distinct stretches of the keys dealt together, and their places."""

    def __init__(self):
        self.places: dict[bytes, list[tuple]] = {}
        self.size = 0

    def add(self, group: dict[bytes, list[tuple]], rule: Rule) -> None:
        for body, where in group.items():
            if body in self.places:
                self.places[body] += where
            else:
                self.places[body] = where
                self.size += body.count(b" ") + 1 if rule.words else len(body)


def _alike(rule: Rule, group: dict[bytes, list[tuple]]) -> bool:
    """All stretches of a whole key are copies of one: the first document
    owns all its windows, and no matcher is needed."""
    (body, where), *more = group.items()
    return not more and not where[0][3] and (rule.across or len(where) > 1)


def _copies(rule: Rule, group: dict[bytes, list[tuple]]) -> Iterator[tuple]:
    (body, where), = group.items()
    n = body.count(b" ") + 1 if rule.words else len(body)
    least = min(p[0] for p in where)
    for doc, th, a, _ in where:
        if not rule.across or doc > least:
            yield doc, th, a, a + n, None, None, None


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return batch_of(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))


def _shards(rule: Rule):
    """Rows come sorted by (key, salt); whole groups are gathered until a
    shard is full, then the matcher runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, group, rows = Shard(), {}, []
        last = None

        def close():
            if group and _alike(rule, group):
                rows.extend(_copies(rule, group))
            else:
                shard.add(group, rule)

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in _CUT.names]
            for key, salt, hot, doc, th, a, body in zip(*cols, strict=True):
                if (key, salt) != last:
                    close()
                    group, last = {}, (key, salt)
                    if shard.size >= rule.shard_items:
                        yield from _found(rule, shard)
                        shard = Shard()
                group.setdefault(body, []).append((doc, th, a, hot))
            if len(rows) > 20_000:
                yield _rows(_FOUND, rows)
                rows = []
        close()
        if rows:
            yield _rows(_FOUND, rows)
        if shard.places:
            yield from _found(rule, shard)
    return run


def _found(rule: Rule, shard: Shard) -> Iterator[pa.RecordBatch]:
    """Rows of one shard: removed ranges [s, e) of items, and for split keys
    the windows not decided here: place s and hash (w1, w2) of each, or s, e
    and content of whole pieces of them."""
    rows: list[tuple] = []
    size = 0
    bodies = list(shard.places)
    for body, verdicts in zip(bodies, rule.match(bodies, shard.places, rule.window), strict=True):
        items = None
        for (doc, th, a, hot), (starts, ends, once) in verdicts:
            rows += [(doc, th, a + s, a + e + rule.window - 1, None, None, None)
                     for s, e in zip(starts, ends, strict=True)]
            if hot and rule.pieces:
                for s, e in once:
                    piece = body[s:e + rule.window - 1]
                    rows.append((doc, th, a + s, a + s + len(piece), None, None, piece))
                    size += len(piece)
            elif hot:
                items = items or (body.split() if rule.words else body)
                for i in once:
                    part = items[i:i + rule.window]
                    d = hashlib.blake2b(b" ".join(part) if rule.words else part, digest_size=16).digest()
                    rows.append((doc, th, a + i, a + i + rule.window,
                                 *(int.from_bytes(d[j:j + 8], "little", signed=True) for j in (0, 8)), None))
        if len(rows) > 50_000 or size > 4 << 20:
            yield _rows(_FOUND, rows)
            rows, size = [], 0
    if rows:
        yield _rows(_FOUND, rows)


def ranges_where(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Half-open ranges of True."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()


def _keep(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (t, spans) in enumerate(zip(texts_of(batch.column("text")), batch.column("spans"), strict=True)):
                xs = spans.as_py()
                s, e = merged_runs(np.array([x["s"] for x in xs]), np.array([x["e"] for x in xs]))
                items = t.split() if rule.words else t
                kept, at = [], 0
                for lo, hi in zip(s.tolist(), e.tolist(), strict=True):
                    kept.append(items[at:lo])
                    at = hi
                kept.append(items[at:])
                out = b" ".join(w for part in kept for w in part) if rule.words else b"".join(kept)
                rows.append((batch.column("_id")[i].as_py(), batch.column("_th")[i].as_py(),
                             int((e - s).sum()), len(s), out))
            if rows:
                yield _rows(_KEPT, rows)
    return run


def merge_across(found: DataFrame, rule: Rule) -> DataFrame:
    """Removed ranges among the windows that split keys left open: equal
    hashes are counted over all shards, with map-side combination."""
    open_ = found.filter(F.col("w1").isNotNull())
    if rule.across:
        agg = open_.groupBy("w1", "w2").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        again = agg.filter(F.col("lo") < F.col("hi"))
    else:
        again = open_.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    hit = open_.join(again, ["w1", "w2"])
    if rule.across:
        hit = hit.filter(F.col("lo") < F.col("_id"))
    return hit.select("_id", "_th", "s", "e")


def matched(cut: DataFrame, rule: Rule) -> DataFrame:
    """What the matcher finds on stretches dealt by ``key`` and ``salt``."""
    # key and salt decide the partition; the sort brings groups together
    dealt = cut.repartition(F.col("key"), F.col("salt")).sortWithinPartitions("key", "salt")
    return stored(dealt.mapInArrow(_shards(rule), _FOUND_DDL), "found")


def decided(found: DataFrame) -> DataFrame:
    """The removed ranges of ``found``."""
    return found.filter(F.col("w1").isNull() & F.col("body").isNull()).select("_id", "_th", "s", "e")


def deal_again(pieces: DataFrame, rule: Rule) -> DataFrame:
    """What the matcher finds on ``pieces`` (_id, _th, s, body: bytes that
    hold no window twice), dealt by the least hash of the longer runs of
    ``rule.gram`` bytes."""
    stretches = stored(pieces.mapInArrow(_split(rule), _PIECE_DDL), "pieces")
    counts = stretches.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    parts = F.ceil(F.col("c") / rule.group_limit)
    return matched(stretches.join(counts, "key").select(
        "key", F.pmod(F.xxhash64("_id", "_th", "a"), parts).alias("salt"),
        (F.col("c") > rule.group_limit).alias("hot"), "_id", "_th", "a", "body"), rule)


def remove_repeats(docs: DataFrame, rule: Rule, merge=merge_across) -> tuple[DataFrame, DataFrame]:
    """(summary, changed). Summary: ``_id, _th, n, digest`` of every row of
    ``docs`` (items, sha256 of the whole). Changed: ``_id, _th, n_removed,
    n_spans, kept`` of the distinct rows that lose something."""
    rows = identified(docs)
    scan = stored(rows.mapInArrow(_scan(rule), _SCAN_DDL), "scan")
    summary = scan.filter(F.col("key").isNull()).select("_id", "_th", "n", "digest")
    stretches = scan.filter(F.col("key").isNotNull()).select("_id", "_th", "key", "a", "b", "n")
    counts = stretches.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("_id").alias("lo"),
                                          F.max("_id").alias("hi"), F.sum("n").alias("places"))
    counts = counts.filter(F.col("lo") < F.col("hi") if rule.across else F.col("places") > 1)
    parts = F.ceil(F.col("c") / rule.group_limit)
    spots = (stretches.join(counts.select("key", "c"), "key")
             .select("_id", "_th", F.struct(
                 "key", F.pmod(F.xxhash64("_id", "_th", "a"), parts).alias("salt"),
                 (F.col("c") > rule.group_limit).alias("hot"), "a", "b").alias("x"))
             .groupBy("_id", "_th").agg(F.collect_set("x").alias("spots")))
    texts = stored(rows.join(spots, ["_id", "_th"]), "texts")
    cut = texts.mapInArrow(_cut(rule), _CUT_DDL)
    found = matched(cut, rule)
    removed = decided(found).unionByName(merge(found, rule))
    spans = removed.groupBy("_id", "_th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    changed = (texts.select("_id", "_th", "text").dropDuplicates(["_id", "_th"])
               .join(spans, ["_id", "_th"]).mapInArrow(_keep(rule), _KEPT_DDL))
    return summary, changed
