"""Operator 2, cross-entropy difference of two n-gram models.

The target model is counted over the documents labelled good, the
background model over all documents. Both are interpolated bigram models
over every word and every bigram of the corpus. The score of a document is
the mean over its tokens of (target loss - background loss): lower is closer
to the target.

Documents are dealt to chunks by a hash of the row. A chunk counts its own
words and bigrams and sends each different one once, by ranges of their
hashes; a range adds the counts of all chunks up and answers each chunk in
the order it asked in, with counts alone. The chunk, made again from the same
rows, has with them all its losses need. Texts are dealt once: both passes
over a chunk read the same shuffle, in one plan, and nothing is stored beside
it. Hashes and counts travel as pressed arrays, so that disk stays at a few
bytes for a token, and a common word is one number of a chunk, however often
it stands there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Words, batch_of, doc_id_of, identity, text_chunks
from contrail.session import ship_code

VOCABULARY = 16_384
BIGRAMS = 300_000
WEIGHT = 0.7          # of the bigram estimate
GROUP_BYTES = 4 << 20  # text of a chunk or a range while there are few of them
CHUNK_MOST = 8 << 20   # of a chunk of a large corpus
RANGE_MOST = 16 << 20  # of a range of a large corpus
FEW = 256

#: What a chunk asks of a range: n hashes, and how often it has them.
_ASKED = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
                    ("c", pa.binary()), ("g", pa.binary())])
_ASKED_DDL = "part int, chunk int, n int, keys binary, c binary, g binary"
#: The answer; of a range of words also their number and that of their tokens,
#: to every chunk, whether it asked or not (n = 0).
_ANSWER = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("c", pa.binary()),
                     ("g", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64()), ("good", pa.int64())])
_ANSWER_DDL = "part int, chunk int, n int, c binary, g binary, types long, tokens long, good long"
_SUMS = pa.schema([("_id", pa.int64()), ("n", pa.int64()), ("bg", pa.float64()), ("tg", pa.float64())])
_SUMS_DDL = "_id long, n long, bg double, tg double"


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of bytes, lowest first, as many as the
    largest needs: planes of high bytes are near constant and compress."""
    x = x.astype(np.uint64)
    planes = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 0
    return x.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = np.frombuffer(data, dtype=np.uint8).reshape(-1, n)
        out[:, :len(planes)] = planes.T
    return out.view(np.uint64).ravel()


def _pressed(x: np.ndarray) -> bytes:
    """``_packed`` with its high planes deflated, each after its length, from
    the highest down to the first that gains nothing by it: in steps between
    hashes the low planes are noise, counts are nearly all 1 or 0."""
    data, n, out = _packed(x), len(x), []
    gains = True
    for at in range(len(data) - n, -1, -n) if n else ():
        plane = data[at:at + n]
        if gains:
            small = zlib.compress(plane, 1, -zlib.MAX_WBITS)
            gains = len(small) < n
            plane = small if gains else plane
        out += [len(plane).to_bytes(4, "little"), plane]
    return b"".join(out)


def _unpressed(data: bytes, n: int) -> np.ndarray:
    planes, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        plane = data[at + 4:at + 4 + size]
        planes.append(plane if size == n else zlib.decompress(plane, -zlib.MAX_WBITS))
        at += 4 + size
    return _unpacked(b"".join(reversed(planes)), n)


def _lowest(k: int, ranges: int) -> np.uint64:
    """The smallest hash of range ``k``."""
    return np.uint64(-((-k << 32) // ranges) << 32)


class _Tokens:
    """Tokens of some rows: row, number of the word and of the bigram in the
    sorted hashes of the different ones; ``second`` are the tokens that have
    a word before them in the same text."""

    def __init__(self, rows: pa.Table):
        hashes, docs, seconds, first = [], [], [], 0
        for batch, texts in text_chunks(rows.to_batches()):
            w = Words(texts)
            hashes.append(w.hash)
            docs.append(w.doc + first)
            seconds.append(np.concatenate([[False], w.doc[1:] == w.doc[:-1]])[:len(w.doc)])
            first += batch.num_rows
        word = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.second = np.flatnonzero(np.concatenate(seconds)) if seconds else np.zeros(0, np.int64)
        self.words, self.word = np.unique(word, return_inverse=True)
        before, of = word[self.second - 1], word[self.second]
        # key of a bigram
        self.pairs, self.pair = np.unique(((before << np.uint64(1)) | (before >> np.uint64(63))) ^ of,
                                          return_inverse=True)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
    """The batches of a group as one."""
    return pa.Table.from_batches(list(batches)).combine_chunks().to_batches()[0]


def _counted(of: np.ndarray, kinds: int, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bincount(of, minlength=kinds), np.bincount(of, good, minlength=kinds)


def _ask(ranges: int):
    """What a chunk sends; its rows and the names of the good documents."""
    def run(rows: pa.Table, marks: pa.Table) -> pa.Table:
        names = {*zip(marks.column("good_id").to_pylist(), marks.column("good_th").to_pylist(), strict=True)}
        good = np.array([x in names for x in zip(rows.column("_id").to_pylist(), rows.column("_th").to_pylist(),
                                                 strict=True)], dtype=np.float64)
        t = _Tokens(rows)
        if not len(t.doc):
            return _ASKED.empty_table()
        good = good[t.doc]
        out = {f.name: [] for f in _ASKED}
        for kind, (keys, c, g) in enumerate(((t.words, *_counted(t.word, len(t.words), good)),
                                             (t.pairs, *_counted(t.pair, len(t.pairs), good[t.second])))):
            part = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(part, np.arange(ranges + 1))
            for k in np.flatnonzero(np.diff(cut)):
                own = slice(cut[k], cut[k + 1])
                steps = np.diff(keys[own], prepend=_lowest(int(k), ranges))
                for name, x in (("part", kind * ranges + k), ("n", len(steps)), ("keys", _pressed(steps)),
                                ("c", _pressed(c[own])), ("g", _pressed(g[own]))):
                    out[name].append(x)
        out["chunk"] = np.repeat(rows.column("chunk")[0].as_py(), len(out["n"]))
        return pa.Table.from_batches([batch_of(_ASKED, **out)])
    return run


def _answer(ranges: int, chunks: int):
    """The counts of a range over all chunks, for each chunk in its order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _rows_of(batches)
        part, chunk, n = group.column("part")[0].as_py(), group.column("chunk"), group.column("n").to_pylist()
        low = _lowest(part % ranges, ranges)
        keys, c, g = (np.concatenate([step(_unpressed(x, m)) for x, m in
                                      zip(group.column(name).to_pylist(), n, strict=True)])
                      for name, step in (("keys", lambda x: low + np.cumsum(x)), ("c", np.asarray), ("g", np.asarray)))
        kinds, at = np.unique(keys, return_inverse=True)
        del keys
        c, g = (np.bincount(at, x, minlength=len(kinds)) for x in (c, g))
        ends = np.cumsum(n)
        cuts = [slice(e - m, e) for e, m in zip(ends, n, strict=True)]
        total = (len(kinds), int(c.sum()), int(g.sum())) if part < ranges else (None,) * 3

        def rows(chunk, n, c, g):
            return batch_of(_ANSWER, part=np.repeat(part, len(n)), chunk=chunk, n=n, c=c, g=g,
                            **{x: pa.array([v] * len(n), pa.int64())
                               for x, v in zip(("types", "tokens", "good"), total, strict=True)})

        yield rows(chunk, n, [_pressed(c[at[s]]) for s in cuts], [_pressed(g[at[s]]) for s in cuts])
        if part < ranges:
            others = np.setdiff1d(np.arange(chunks), chunk.to_numpy())
            none = [b""] * len(others)
            yield rows(others, np.zeros(len(others), np.int32), none, none)
    return run


def _score(ranges: int):
    """Tokens and losses of each row of a chunk, by the answers it got."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _SUMS.empty_table()
        size, tokens, good = (pa.compute.sum(answers.column(x)).as_py() or 0 for x in ("types", "tokens", "good"))
        size += 1  # the unknown word counts as one
        counts = sorted(answers.select(["part", "n", "c", "g"]).to_pylist(), key=lambda r: r["part"])
        t = _Tokens(rows)
        losses = []
        for name, total in (("c", tokens), ("g", good)):
            alone, both = (np.concatenate([np.zeros(0), *[_unpressed(r[name], r["n"]) for r in counts
                                                          if (r["part"] >= ranges) == pairs]]) for pairs in (False, True))
            p = (alone + 0.5) / (total + 0.5 * size)
            a, b = np.zeros(len(both), dtype=np.int64), np.zeros(len(both), dtype=np.int64)
            a[t.pair], b[t.pair] = t.word[t.second - 1], t.word[t.second]
            loss = -np.log(p)[t.word]
            loss[t.second] = -np.log((1 - WEIGHT) * p[b] + WEIGHT * both / np.maximum(alone[a], 1))[t.pair]
            losses.append(np.bincount(t.doc, loss, minlength=rows.num_rows))
        return pa.Table.from_batches([batch_of(
            _SUMS, _id=rows.column("_id").combine_chunks(), n=np.bincount(t.doc, minlength=rows.num_rows),
            bg=losses[0], tg=losses[1])])
    return run


def _groups(size: int, most: int) -> int:
    """Number of groups for so many bytes: of at most ``GROUP_BYTES``, up to
    ``FEW``, beyond that of ``most``."""
    return max(1, min(FEW, math.ceil(size / GROUP_BYTES)), math.ceil(size / most))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, vocabulary: int = VOCABULARY,
                             bigrams: int = BIGRAMS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every row of
    ``docs`` (``doc_id``, ``text``); losses in nats per token.

    A document is good if a row of ``labels`` gives it quality 1; null ids
    and labels are not. Null and empty texts have no token, losses and score
    0. Repeated rows count as often as they stand there. Without good
    documents the target model is uniform. An empty table gives no rows;
    further columns are ignored, whatever their names. ``vocabulary`` and
    ``bigrams`` set the size of a broadcast tier that is gone; no result
    hangs on them."""
    ship_code()
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(
        labels["doc_id"].alias("__id")).distinct()
    rows = docs.select(*identity(docs), docs["doc_id"].cast("long").alias("doc_id"),
                       docs["text"].cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, ranges = _groups(size, CHUNK_MOST), _groups(size, RANGE_MOST)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("_id", "_th"), F.lit(chunks)).cast("int"))
    # the same columns in both passes, so that Spark deals the texts once and reads that shuffle again
    texts = rows.select("chunk", "_id", "_th", "text").groupBy("chunk")
    # labels grow with the documents: never broadcast, one plan at every size; ids are joined, texts are not
    marks = rows.join(good.hint("merge"), rows["doc_id"] == good["__id"], "left_semi").select(
        *[F.col(x).alias(f"good{x}") for x in ("chunk", "_id", "_th")])

    asked = texts.cogroup(marks.groupBy("goodchunk")).applyInArrow(_ask(ranges), _ASKED_DDL)
    answers = asked.groupBy("part").applyInArrow(_answer(ranges, chunks), _ANSWER_DDL)
    sums = texts.cogroup(answers.groupBy("chunk")).applyInArrow(_score(ranges), _SUMS_DDL)
    mean = [F.round(F.col(x) / F.greatest(F.col("n"), F.lit(1)), 6) for x in ("tg", "bg")]
    return sums.select(doc_id_of(), F.col("n").alias("n_tokens"), mean[0].alias("target_loss"),
                       mean[1].alias("background_loss"), F.round(mean[0] - mean[1], 6).alias("score"))
