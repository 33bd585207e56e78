"""Helpers the operators share: reading tables, row identity, word and
hash arithmetic in numpy on chunks of documents.

Row identity. Tables may repeat a ``doc_id`` or hold null ids, so rows are
joined on ``(_id, _th)``: the id with null read as the largest long, and a
64-bit hash of the text. Exactly repeated rows share the identity and get
equal results; every operator returns one row per input row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import cut_lineage, ship_code

NULL_ID = (1 << 63) - 1
CHUNK_BYTES = 2 << 20  # text handled at once by one numpy pass

#: Base of the polynomial hashes (odd, so it has an inverse modulo 2^64).
BASE = 0x9E3779B97F4A7C15
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def identity(docs: DataFrame) -> list:
    """The columns ``_id`` and ``_th``."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("_id"),
            F.xxhash64(docs["text"]).alias("_th")]


def identified(docs: DataFrame) -> DataFrame:
    """(_id, _th, text) of every row of ``docs``; other columns, whatever
    their names, are left out."""
    ship_code()
    return docs.select(*identity(docs), docs["text"].cast("string").alias("text"))


#: Columns of documents that operators read by name.
_READ = ("doc_id", "text", "source", "n_chars")


def with_plain_names(docs: DataFrame, step) -> DataFrame:
    """``step(docs)`` with the columns that no operator reads under names
    that clash with nothing, and called as before in its result."""
    plain = docs.toDF(*[c if c in _READ else f"column_{i}" for i, c in enumerate(docs.columns)])
    names = dict(zip(plain.columns, docs.columns, strict=True))
    out = step(plain)
    return out.toDF(*[names.get(c, c) for c in out.columns])


def without_columns(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``docs`` without the columns of these names, in any case."""
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in names])


def doc_id_of(col: str = "_id"):
    return F.when(F.col(col) != NULL_ID, F.col(col)).alias("doc_id")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return cut_lineage(df, name)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES):
    """(record batch slice, texts) with at most ``limit`` bytes of text, or
    one row; the column is ``text``."""
    for batch in batches:
        texts = texts_of(batch.column("text"))
        lo, size = 0, 0
        for i, t in enumerate(texts):
            if i > lo and size + len(t) > limit:
                yield batch.slice(lo, i - lo), texts[lo:i]
                lo, size = i, 0
            size += len(t)
        if lo < len(texts):
            yield batch.slice(lo), texts[lo:]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def byte_values(salt: int = 1) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(0x1234567 * salt + 1))


class RangeHash:
    """64-bit hashes of ranges of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        up = np.full(n + 1, np.uint64(base))
        up[0] = 1
        np.cumprod(up, out=up)
        down = np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)))
        down[0] = 1
        np.cumprod(down, out=down)
        self.down = down
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of ``k`` consecutive values."""
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k])


class Words:
    """Words of a chunk of texts as arrays: byte ranges, hashes, and the
    range of words of each text."""

    def __init__(self, texts: list[bytes], sep: np.ndarray = WHITE, fold: np.ndarray | None = None,
                 hashes: bool = True):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.raw = raw
        self.buf = raw if fold is None else fold[raw]
        inside = np.zeros(len(raw) + 1, dtype=np.int8)
        inside[1:] = ~sep[self.buf]
        step = np.diff(inside)
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.text_at = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.starts, self.text_at)  # words before each text
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        if hashes:
            self.hash = RangeHash(byte_values()[self.buf]).of(self.starts, self.ends)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n, span, cur = len(values), 1, values
    if n < w:
        return values[:0]
    while span * 2 <= w:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    if span < w:
        cur = np.minimum(cur[:n - w + 1], cur[w - span:])
    return cur


def merged_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as disjoint ranges in order; touching
    ranges become one."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]]) if len(s) else np.zeros(0, bool)
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]]) if len(s) else np.zeros(0, int)
    return s[new], e[last]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
