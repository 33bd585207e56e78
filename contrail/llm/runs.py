"""Operator 12, periodic runs by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q that no neighbouring word
extends. The words of a stretch are appended to a suffix automaton one by
one. Its suffix-link tree is kept as a link-cut tree whose preferred paths
hold one colour each: the place where their strings ended last. Access to
the state of the whole text recolours the way to the root with the new end,
path segment by path segment. A segment of greatest length L that ended last
at distance d of here, d <= L, shows a square: the last L + d words have
period d, which is the smallest (an earlier one would have ended later), and
do not reach further to the left. Where the next word breaks the period, that
stretch is a run, so each run is found once, at its last word.

Words outside repeats never enter an automaton: in a run of length n >= 24
and period q <= n / 3, every 16 words from one place stand again q words on.
Stretches that repeated 16-word windows cover are found by hashes, again
inside each stretch until that shortens nothing. This leaves out only words
that no run holds.

Every text is handled whole, inside one task, without a shuffle. Memory grows
with the longest repetitive stretch of one text, some 0.6 KB a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import RangeHash, Words, batch_of, merged_runs, mix, text_chunks
from contrail.session import ship_code

LENGTH = 24   # words of a run at least
TIMES = 3     # periods of a run at least
ROUNDS = 8    # passes of the filter at most; any number is right


def runs_of(words: list, length: int = LENGTH, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` (hashable, two at
    least ``times``), by their ends."""
    n = len(words)
    nxt: list = [None, {}]
    link, size = [0, 0], [0, 0]
    # link-cut tree without the root state: children in a path's splay tree
    # (left is nearer to the root), parent or path parent, last end (at splay roots)
    left, right, up, seen = [0, 0], [0, 0], [0, 0], [-1, -1]

    def state(longest, ways, parent):
        nxt.append(ways)
        size.append(longest)
        link.append(parent)
        left.append(0)
        right.append(0)
        up.append(parent if parent != 1 else 0)
        seen.append(-1)
        return len(size) - 1

    def rotate(x):
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x

    def splay(x):
        while True:
            p = up[x]
            if left[p] != x and right[p] != x:
                return
            g = up[p]
            if left[g] == p or right[g] == p:
                seen[x] = seen[g]
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                seen[x] = seen[p]
            rotate(x)

    found = []
    last = 1
    for i, c in enumerate(words):
        cur = state(i + 1, {}, 1)
        p = last
        last = cur
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                over = q
            else:  # a copy of q for the shorter strings, between q and its parent
                over = state(size[p] + 1, dict(nxt[q]), link[q])
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = over
                    p = link[p]
                splay(q)
                above = left[q]
                if above:
                    up[above], seen[above], left[q] = up[q], seen[q], 0
                up[q] = link[q] = over
                seen[over] = seen[q]
            link[cur] = up[cur] = over
        # access: walk the segments from here to the root and recolour them
        below, x, before = cur, up[cur], -1
        while x:
            splay(x)
            end = seen[x]
            if end != before:
                before, d = end, i - end
                if size[x] >= (times - 1) * d and size[x] + d >= length and (i + 1 == n or words[i + 1] != words[i + 1 - d]):
                    found.append((i + 1 - size[x] - d, size[x] + d, d))
            if right[x]:
                seen[right[x]] = end
            right[x] = below
            below, x = x, up[x]
        seen[below] = i
    return found


def stretches(hashes: np.ndarray, owner: np.ndarray, length: int = LENGTH, times: int = TIMES):
    """(start, end) word ranges, each inside one owner, outside of which no
    run lies. ``hashes`` are of words, ``owner`` the number of their text."""
    gram = length - length // times
    at = np.arange(len(hashes))
    for _ in range(ROUNDS):
        if len(at) < length:
            return np.zeros(0, int), np.zeros(0, int)
        # ``owner`` numbers stretches in order, so a stretch's words stand together
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        lens = np.diff(np.concatenate([starts, [len(at)]]))
        far = np.repeat(lens // times, lens)
        key = RangeHash(hashes[at]).grams(gram)
        inside = np.flatnonzero(owner[gram - 1:] == owner[:len(key)])
        key = mix(key[inside] ^ mix(owner[inside].astype(np.uint64) + np.uint64(7)))
        order = np.argsort(key, kind="stable")
        a, b = inside[order[:-1]], inside[order[1:]]
        near = (key[order[:-1]] == key[order[1:]]) & (b - a <= far[a]) & (owner[a] == owner[b])
        hit = np.unique(np.concatenate([a[near], b[near]]))
        if not len(hit):
            return np.zeros(0, int), np.zeros(0, int)
        s, e = merged_runs(hit, hit + gram)
        # windows of two stretches that touch were merged: cut them at owners
        edge = np.zeros(len(at) + 1, dtype=np.int64)
        np.add.at(edge, s, 1)
        np.add.at(edge, e, -1)
        covered = np.cumsum(edge[:-1]) > 0
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | ~covered[:-1] | (at[1:] != at[:-1] + 1)])
        ids = np.cumsum(new)
        keep = covered & (np.bincount(ids[covered], minlength=ids[-1] + 1)[ids] >= length)
        same = keep.all()
        at, owner = at[keep], ids[keep]
        if same and len(np.unique(owner)) == len(starts):
            break
    if not len(at):
        return np.zeros(0, int), np.zeros(0, int)
    cut = np.concatenate([[True], owner[1:] != owner[:-1]])
    s = at[cut]
    e = at[np.concatenate([cut[1:], [True]])] + 1
    return s, e


def text_runs(texts: list[bytes], length: int = LENGTH, times: int = TIMES) -> list[tuple[list, list]]:
    """(words, runs sorted by start, then period) of every text."""
    words = [t.split() for t in texts]  # splits at the bytes 20 and 09 to 0D
    chunk = Words(texts)
    out = [[] for _ in texts]
    for s, e in zip(*stretches(chunk.hash, chunk.doc, length, times), strict=True):
        d = int(chunk.doc[s])
        base = int(s - chunk.first[d])
        names: dict[bytes, int] = {}
        ids = [names.setdefault(w, len(names)) for w in words[d][base:base + int(e - s)]]
        out[d] += [(base + a, n, q) for a, n, q in runs_of(ids, length, times)]
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(words, out, strict=True)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return b" ".join(words)
    start, n, period = (np.array(x) for x in zip(*runs, strict=True))
    out, at = [], 0
    for s, e in zip(*merged_runs(start + period, start + n), strict=True):
        out += words[at:s]
        at = e
    return b" ".join(out + words[at:])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)),
                  ("strongest", _RUN), ("collapsed", pa.string())])


def _as_run(r) -> dict:
    return {"start": r[0], "length": r[1], "period": r[2]}


def _strongest(runs):
    best = None
    for r in runs:  # sorted by start and period, so the first of equals stays
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return None if best is None else _as_run(best)


def periodic_runs(docs: DataFrame, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs, strongest, collapsed of every row of ``docs``
    (doc_id, text).

    ``runs`` holds (start, length, period) of every stretch of words with
    smallest period ``period`` that no word extends, of ``length`` words and
    ``times`` periods at least, sorted by start and period; ``strongest`` is
    the one with the greatest length / period (ties: the smallest start, then
    period), null without runs. ``collapsed`` is the text's words joined by
    one space, without those that a run holds after its first period. Words
    are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words
    and an empty ``collapsed``. Repeated rows and null ids are rows like any
    other; an empty table gives no rows; other columns are ignored, whatever
    their names. ``times`` is 2 or more, ``length`` 2 or more."""
    ship_code()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            done = text_runs(texts, length, times)
            yield batch_of(
                _OUT, doc_id=part.column("doc_id"), n_words=[len(w) for w, _ in done],
                runs=[[_as_run(r) for r in rs] for _, rs in done], strongest=[_strongest(rs) for _, rs in done],
                collapsed=pa.array([collapsed(w, rs) for w, rs in done], pa.binary()).cast(pa.string()))

    run = "struct<start:long,length:long,period:long>"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(
        find, f"doc_id long, n_words long, runs array<{run}>, strongest {run}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a periodic tail in the texts whose id's CRC is
    divisible by 10; rows without id stay as they are."""
    h = F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(docs["text"].cast("string"), F.lit(r"([^\x20\x09-\x0D]+)"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))

    def source(i):
        a, p = F.col("a"), F.col("p")
        return F.get("w", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), source), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256 of every row of ``docs``, after :func:`planted`;
    nulls, empty and repeated rows as :func:`periodic_runs` has them."""
    found = periodic_runs(planted(docs))
    best = F.col("strongest")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
