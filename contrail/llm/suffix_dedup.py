"""Operator 6, suffix-array dedup over bytes.

Stretches of bytes that share a key with another place
(:mod:`contrail.llm.repeats`) are dealt to shards. Each shard sorts the
suffixes of its distinct stretches in numpy by Larsson-Sadakane refinement
(ranks of the first 8 bytes, then doubled; only groups that are still tied
are sorted again, up to the window length), takes common-prefix lengths by
Kasai's rule (the next suffix in text order loses at most one character),
all stretches in step, and marks each window whose neighbour in suffix order
agrees on the whole window.

Keys split over several shards are merged by rounds. A shard hands on each
different window it holds once, equal ones by their first place, as pieces
of text: a group of near copies hands on one whole copy and the
surroundings of each change. Pieces are dealt again by the least hash of a
longer run and sorted in new shards; a window that stands in many thousand
shards stands in a few after a round. What is split after the longest run,
too, is compared window by window, by binary search in sorted runs of
128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import batch_of, doc_id_of
from contrail.llm.repeats import Rule, deal_again, decided, ranges_where, remove_repeats

WINDOW = 400      # bytes
GRAM = 64         # bytes hashed for a key
SHARD_BYTES = 2 << 20
ROUNDS = (0.4, 0.6, 0.8)  # longer runs that split keys are dealt by, as parts of the window


def _eight(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as one big-endian number; ``buf``
    has 8 bytes of padding at its end."""
    n = len(buf) - 8
    out = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | buf[k:k + n]
    return out


#: Least numbers of 1, 2, ... 8 bytes.
_TOPS = np.array([1] + [1 << (8 * k) for k in range(1, 8)], dtype=np.uint64)


_LANE = 512


def suffix_array(codes: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of the positions of ``codes`` (first 8 symbols
    of each suffix), where the text of position i stops at ``ends[i]``;
    ordered by the first ``depth`` symbols at least."""
    n = len(codes)
    sa = np.argsort(codes)
    new = np.concatenate([[True], codes[sa][1:] != codes[sa][:-1]])
    # the rank of a group is the place of its last member; ranks are final once a group is single
    group_end = np.concatenate([np.flatnonzero(new)[1:] - 1, [n - 1]])
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = group_end[np.cumsum(new) - 1]
    h = 8
    while h < depth:
        sorted_rank = rank[sa]
        tied = np.zeros(n, dtype=bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        pos = sa[slots]
        ahead = pos + h
        second = np.where(ahead < ends[pos], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(sorted_rank[slots] * (n + 1) + second)
        pos, second, first = pos[order], second[order], sorted_rank[slots][order]
        sa[slots] = pos
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        group_last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pos) - 1]])
        rank[pos] = slots[group_last[np.cumsum(new) - 1]]
        h *= 2
    return sa, rank


def common_prefixes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray,
                    before: np.ndarray, tied: np.ndarray, end_of: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix, up to ``cap``, of each suffix and the one before it in
    suffix order (``place``: its place in that order, -1 outside it;
    ``before``: its predecessor, -1 for none; ``tied``: they share a rank,
    so they agree up to ``cap``), by Kasai's rule: if j comes before i and
    j+1 before i+1, the value falls by one at most. The lanes are the texts
    [starts, ends), walked in step."""
    out = np.zeros(len(codes), dtype=np.int32)
    # long texts become several lanes, so that no lane is much longer than the others
    pieces = -(-(ends - starts) // _LANE)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts, ends = np.repeat(starts, pieces) + nth * _LANE, np.repeat(ends, pieces)
    ends = np.minimum(ends, starts + _LANE)
    order = np.argsort(starts - ends)
    starts, ends = starts[order], ends[order]
    codes = np.concatenate([codes, np.zeros(64, dtype=np.uint64)])
    steps = np.arange(0, 64, 8)
    lcp = np.zeros(len(starts), dtype=np.int64)
    for t in range(int((ends - starts).max(initial=0))):
        live = np.searchsorted(-(ends - starts), -t, side="left")  # lanes longer than t
        i = starts[:live] + t
        j = before[i]
        follows = np.zeros(live, dtype=np.int64) - 1  # place of the old predecessor's next suffix
        if t:
            old = before[i - 1]
            follows = np.where(old >= 0, place[old + 1], -1)
        h = np.where((j >= 0) & (follows >= 0) & (follows < place[i]), np.maximum(lcp[:live] - 1, 0), 0)
        room = np.where(j >= 0, np.minimum(np.minimum(end_of[i] - i, end_of[np.maximum(j, 0)] - j), cap), 0)
        h = np.where(tied[i], room, np.minimum(h, room))
        go = np.flatnonzero(h < room)
        while len(go):  # 64 bytes at a time
            x = codes[(i[go] + h[go])[:, None] + steps] ^ codes[(j[go] + h[go])[:, None] + steps]
            col = np.argmax(x != 0, axis=1)
            diff = x[np.arange(len(go)), col]
            equal = np.where(diff == 0, 64, 8 * col + 8 - np.searchsorted(_TOPS, diff, side="right"))
            h[go] = np.minimum(h[go] + equal, room[go])
            go = go[(equal == 64) & (h[go] < room[go])]
        lcp[:live] = h
        out[i] = h
    return out


def repeated_windows(bodies: list[bytes], window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text: which of its windows also start elsewhere in these
    texts, and which are the first of their kind in them."""
    lengths = np.array([len(b) for b in bodies])
    buf = np.frombuffer(b"".join(bodies) + bytes(8), dtype=np.uint8)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    end_of = np.repeat(ends, lengths)
    codes = _eight(buf)
    # what lies beyond the end of a text must not decide: shift it out
    over = np.maximum(np.arange(len(codes)) + 8 - end_of, 0).astype(np.uint64)
    inner = (codes >> (over * np.uint64(8))) << (over * np.uint64(8))
    sa, rank = suffix_array(inner, end_of, window)
    whole = sa[end_of[sa] - sa >= window]  # suffixes that start a window, in order
    before = np.full(len(codes), -1, dtype=np.int64)
    before[whole[1:]] = whole[:-1]
    tied = np.zeros(len(codes), dtype=bool)
    tied[whole[1:]] = rank[whole[1:]] == rank[whole[:-1]]
    place = np.full(len(codes) + 1, -1, dtype=np.int64)
    place[whole] = np.arange(len(whole))
    lcp = common_prefixes(codes, starts, ends - window + 1, place, before, tied, end_of, window)
    hit = np.zeros(len(codes), dtype=bool)
    again = whole[1:][lcp[whole[1:]] >= window]
    hit[again] = True
    hit[before[again]] = True
    first = np.zeros(len(codes), dtype=bool)
    if len(whole):
        kinds = np.flatnonzero(np.concatenate([[True], lcp[whole[1:]] < window]))
        first[np.minimum.reduceat(whole, kinds)] = True
    return [(hit[s:e - window + 1], first[s:e - window + 1])
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def match_bytes(bodies: list[bytes], places: dict, window: int):
    """For each distinct stretch: (place, (starts, ends, open)) of every
    place. A stretch with two places repeats as a whole. Of a split key the
    first of each kind of window goes on, the decided ones too: they may
    decide windows of other shards."""
    for body, (hit, first) in zip(bodies, repeated_windows(bodies, window), strict=True):
        where = places[body]
        if len(where) > 1:
            hit = np.ones(len(hit), dtype=bool)
        ranges = ranges_where(hit)
        open_ = list(zip(*ranges_where(first), strict=True)) if where[0][3] else ()
        yield [(place, (*ranges, open_ if n == 0 else ())) for n, place in enumerate(where)]


_SPAN = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
_WINDOW = pa.schema([*_SPAN, ("w1", pa.int64()), ("w2", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of one hash range. Each batch is a sorted run; a window is
    looked up by binary search in the merged runs, and what is found more
    than once there by the first half of the hash is compared by the second."""
    runs = [b for b in batches if b.num_rows]
    if not runs:
        return
    merged = np.sort(np.concatenate([r.column("w1").to_numpy() for r in runs]))
    twice = []
    for r in runs:
        w1 = r.column("w1").to_numpy()
        times = np.searchsorted(merged, w1, side="right") - np.searchsorted(merged, w1, side="left")
        twice.append(r.filter(pa.array(times > 1)))
    t = pa.Table.from_batches(twice).combine_chunks()
    if not len(t):
        return
    w1, w2 = t["w1"].to_numpy(), t["w2"].to_numpy()
    order = np.lexsort((w2, w1))
    same = (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
    hit = np.zeros(len(t), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    yield from t.select(_SPAN.names).filter(pa.array(hit)).cast(_SPAN).to_batches()


def _windows(window: int):
    """Place and 128-bit hash of each window of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, th, s, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = len(body) - window + 1
                digests = b"".join(hashlib.blake2b(body[i:i + window], digest_size=16).digest() for i in range(n))
                w = np.frombuffer(digests, dtype=np.int64).reshape(n, 2)
                yield batch_of(_WINDOW, _id=np.full(n, doc), _th=np.full(n, th), s=np.arange(s, s + n),
                               e=np.arange(s, s + n) + window, w1=w[:, 0], w2=w[:, 1])
    return run


def merge_shards(found: DataFrame, rule: Rule) -> DataFrame:
    """Removed ranges among the windows that shards of split keys hand on."""
    removed = found.select("_id", "_th", "s", "e").limit(0)
    for part in ROUNDS:
        pieces = found.filter(F.col("body").isNotNull()).select("_id", "_th", "s", "body")
        if pieces.isEmpty():
            return removed
        found = deal_again(pieces, replace(rule, gram=max(rule.gram, int(rule.window * part))))
        removed = removed.unionByName(decided(found))
    pieces = found.filter(F.col("body").isNotNull()).select("_id", "_th", "s", "body")
    return removed.unionByName(
        pieces.mapInArrow(_windows(rule.window), "_id long, _th long, s long, e long, w1 long, w2 long")
        .repartition(F.col("w1"), F.col("w2")).mapInArrow(_search, "_id long, _th long, s long, e long"))


RULE = Rule(window=WINDOW, gram=GRAM, words=False, across=False, match=match_bytes, shard_items=SHARD_BYTES,
            pieces=True)


def suffix_dedup(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (binary,
    null where nothing went) of every row of ``docs`` (``doc_id``, ``text``).

    Texts are UTF-8 bytes, null as empty. A byte goes if a string of
    ``rule.window`` bytes that covers it also starts anywhere else, in the
    same text too; strings never cross texts. Repeated rows are separate
    places, so they remove each other. Further columns of ``docs`` are
    ignored, whatever their names."""
    summary, changed = remove_repeats(docs, rule, merge_shards)
    new = changed.withColumn("kept_sha256", F.sha2("kept", 256))
    return summary.join(new, ["_id", "_th"], "left").select(
        doc_id_of(), F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"), "kept")
