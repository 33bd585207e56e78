"""Operator 7, quality classifier by attention-based multiple-instance
learning.

A document is a bag of passages of ``PASSAGE`` words; all passages of the
whole text are encoded. A passage is described by the make-up of its bytes
and words (classes of bytes, hashed byte pairs, repetition, shapes of
words). Each passage is embedded, a gated attention (a tanh branch times a
sigmoid branch) gives it a weight inside its document, and the weighted sum
of the embeddings is scored. The weights are learned from document labels
only. Inputs are the text and nothing else.

The model is fitted on the driver from all passages of about ``train_rows``
labelled documents at most, outside the held-out fold and chosen by hash.
Scoring uses every passage of every document, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import Words, batch_of, text_chunks
from contrail.session import ship_code

PASSAGE = 64
TRAIN_ROWS = 6_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
_CLASSES, _PAIRS, _SHAPES = 14, 64, 11
DIM = _CLASSES + _PAIRS + _SHAPES


def _byte_classes() -> np.ndarray:
    c = np.full(256, 13, dtype=np.int64)
    c[97:123], c[65:91], c[48:58], c[128:192], c[192:256] = 0, 1, 2, 3, 4
    for k, chars in enumerate((b".,;:", b"!?", b"|", b"%&$", b"#*@", b"'\"()[]{}<>", b"-_/\\=+~^", b"`")):
        c[list(chars)] = 5 + k
    return c


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each text); a text
    without words has one passage of zeros."""
    w = Words(texts)
    n = np.maximum(-(-w.counts // PASSAGE), 1)
    base = np.concatenate([[0], np.cumsum(n)])
    total = int(base[-1])
    out = np.zeros((total, DIM), dtype=np.float64)
    if not len(w.starts):
        return out, n
    nth = np.arange(len(w.starts)) - w.first[w.doc]
    passage = base[w.doc] + nth // PASSAGE
    length = w.ends - w.starts
    owner = np.repeat(passage, length)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(w.starts, length)
    b = w.buf[at].astype(np.int64)
    size = np.bincount(owner, minlength=total)[:, None].clip(1)
    count = np.bincount(passage, minlength=total)[:, None].clip(1)
    cls = _byte_classes()[b]
    out[:, :_CLASSES] = np.bincount(owner * _CLASSES + cls, minlength=total * _CLASSES).reshape(total, -1) / size
    pair = (b[:-1] * 31 + b[1:] * 17 + (b[1:] >> 3)) % _PAIRS
    same = owner[:-1] == owner[1:]
    out[:, _CLASSES:_CLASSES + _PAIRS] = np.bincount(
        owner[:-1][same] * _PAIRS + pair[same], minlength=total * _PAIRS).reshape(total, -1) / size
    letters = np.concatenate([[0], np.cumsum(cls <= 4)])
    upper = np.concatenate([[0], np.cumsum(cls == 1)])
    end = np.cumsum(length)
    has = letters[end] - letters[end - length]
    ups = upper[end] - upper[end - length]

    def again(k):
        x = np.zeros(len(w.hash), dtype=bool)
        x[k:] = (w.hash[k:] == w.hash[:-k]) & (passage[k:] == passage[:-k])
        return x

    order = np.lexsort((w.hash, passage))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    first = np.empty(len(order), dtype=bool)
    first[order] = fresh
    head, tail = w.buf[w.starts], w.buf[w.ends - 1]
    shapes = [length / 10.0, length == 1, (head >= 65) & (head <= 90), ups == length, has == 0, has < length,
              again(1), again(2), first, np.isin(tail, list(b".,;:!?")), (length > 15)]
    for k, v in enumerate(shapes):
        out[:, _CLASSES + _PAIRS + k] = np.bincount(passage, weights=v, minlength=total) / count[:, 0]
    return out, n


class Model:
    """Gated-attention MIL network; plain numpy."""

    def __init__(self, dim: int = DIM, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(dim), np.ones(dim)
        self.constant: float | None = None
        self.p = {"W": r.normal(0, dim ** -0.5, (dim, hidden)), "b": np.zeros(hidden),
                  "V": r.normal(0, hidden ** -0.5, (hidden, gate)), "U": r.normal(0, hidden ** -0.5, (hidden, gate)),
                  "w": r.normal(0, gate ** -0.5, gate), "c": r.normal(0, hidden ** -0.5, hidden), "d": np.zeros(1)}

    def _forward(self, x, n):
        p, start = self.p, np.cumsum(n) - n
        e = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(e @ p["V"]), 1 / (1 + np.exp(-(e @ p["U"])))
        logit = (t * s) @ p["w"]
        logit = np.exp(logit - np.repeat(np.maximum.reduceat(logit, start), n))
        a = logit / np.repeat(np.add.reduceat(logit, start), n)
        z = np.add.reduceat(a[:, None] * e, start)
        y = 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))
        return e, t, s, a, z, y

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Score of each bag; ``n`` passages each."""
        if self.constant is not None:
            return np.full(len(n), self.constant)
        return self._forward(np.clip((x - self.mean) / self.scale, -8, 8), n)[-1] if len(n) else np.zeros(0)

    def fit(self, x, n, label, epochs: int = 25, batch: int = 64, rate: float = 5e-3, seed: int = 11) -> Model:
        """Adam on the log loss, classes as they come."""
        if not len(label) or label.min() == label.max():
            self.constant = float(label[0]) if len(label) else 1.0
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        start = np.cumsum(n) - n
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = r.permutation(len(n))
            for lo in range(0, len(order), batch):
                ids = order[lo:lo + batch]
                rows = np.concatenate([np.arange(start[i], start[i] + n[i]) for i in ids])
                g = self._gradient(x[rows], n[ids], label[ids])
                step += 1
                for k, v in g.items():
                    m1[k] = 0.9 * m1[k] + 0.1 * v
                    m2[k] = 0.999 * m2[k] + 0.001 * v * v
                    self.p[k] = self.p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _gradient(self, x, n, label):
        p = self.p
        e, t, s, a, z, y = self._forward(x, n)
        dy = (y - label) / len(n)
        dz = np.repeat(dy[:, None] * p["c"], n, axis=0)
        da = (dz * e).sum(1)
        mean = np.repeat(np.add.reduceat(a * da, np.cumsum(n) - n), n)
        dl = a * (da - mean)
        dt, ds = dl[:, None] * p["w"] * s * (1 - t * t), dl[:, None] * p["w"] * t * s * (1 - s)
        de = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - e * e)
        return {"W": x.T @ de + 1e-5 * p["W"], "b": de.sum(0), "V": e.T @ dt, "U": e.T @ ds, "w": (t * s).T @ dl,
                "c": z.T @ dy + 1e-4 * p["c"], "d": np.array([dy.sum()])}


_BAG = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("quality", pa.int32()), ("n", pa.int32()), ("x", pa.binary())])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_chunks(batches):
        x, n = features(texts)
        ends = np.cumsum(n)
        yield batch_of(_BAG, doc_id=batch.column("doc_id"), th=batch.column("th"), quality=batch.column("quality"), n=n,
                       x=[x[e - k:e].astype("<f4").tobytes() for e, k in zip(ends, n, strict=True)])


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Model from all passages of labelled documents that are not held out,
    of about ``train_rows`` ids (by a hash of the id, if more are labelled).
    Null labels and null ids are left out; of repeated labels of an id the
    smallest counts, of rows that repeat an id the one with the least text
    hash."""
    ship_code()
    use = (labels.filter(labels["doc_id"].isNotNull() & labels["quality"].isNotNull() & ~held_out(labels["doc_id"]))
           .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    share = min(1.0, train_rows / max(1, use.count()))
    cut = int(share * (1 << 32))
    some = use.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 32)) < cut)  # bounded by train_rows
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                        F.coalesce(F.xxhash64(docs["text"]), F.lit(0).cast("long")).alias("th"))
    # one row of each id before the features are taken, so that the driver gets train_rows of them
    first = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("th", "quality", "text")).alias("r")).select("doc_id", "r.th", "r.quality", "r.text")
    bags = first.mapInArrow(_bags, "doc_id long, th long, quality int, n int, x binary").orderBy("doc_id").collect()
    n = np.array([b["n"] for b in bags], dtype=np.int64)
    x = np.frombuffer(b"".join(b["x"] for b in bags), "<f4").reshape(-1, DIM).astype(np.float64)
    return Model().fit(x, n, np.array([b["quality"] for b in bags], dtype=np.float64))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            y = model.score(*features(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(y)], names=[*batch.schema.names, "__score"])
    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1
    if score >= 0.7) added; columns of these names are replaced. Null and
    empty texts are scored as a passage without words. Every row is scored
    by itself, so repeated rows get equal scores."""
    ship_code()
    keep = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(*[docs[c] for c in keep])
    out = rows.mapInArrow(_score(model),
                          rows.withColumn("__score", F.lit(0.0)).schema)
    return out.withColumns({"score": F.round("__score", 9)}).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")).drop("__score")


def quality_scores(docs: DataFrame, labels: DataFrame, **setting) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (see
    :func:`scored`). Without any label, or with one class only, the score is
    that class (1 without labels)."""
    model = train(docs, labels, **setting)
    some = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    return scored(some, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
