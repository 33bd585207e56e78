"""Operator 8, token counts by a map-side two-tier lookup.

A byte-level BPE never merges across pre-tokens, so the token count of a
text is the sum of the lengths of its pre-tokens. The first tier is a hash
table of frequent pre-tokens and their lengths, taken from a bounded sample
of documents and broadcast; the second is a cache in each worker, filled by
encoding what the first tier misses. Both only save work: every length comes
from the tokenizer itself. No pre-token is shuffled.

Added tokens in a text are cut out first, as the library does by default;
each is one token.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import ship_code

#: Fixed value: the pattern by which byte-level BPE cuts text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FREQUENT = 20_000       # entries of the broadcast table
SAMPLE_ROWS = 5_000     # documents it is taken from, about
CACHE = 500_000         # entries of a worker's cache
LONGEST = 64            # characters; longer pre-tokens are encoded, not kept
OVER = 1024


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letters byte-level BPE writes bytes as: printable ones stand for
    themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Lengths(dict):
    """Token count by pre-token: the frequent tier, which stays, and above it
    what was encoded on a miss."""

    def __init__(self, encoder, frequent: dict[str, int]):
        super().__init__(frequent)
        self.first, self.tokenize, self.letters = frequent, encoder.model.tokenize, _byte_letters()

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
        if len(piece) <= LONGEST:
            if len(self) >= CACHE + len(self.first):
                self.clear()
                self.update(self.first)
            self[piece] = n
        return n


class PieceCounter:
    """Token counts with one tokenizer; lives in a worker."""

    def __init__(self, spec: str, frequent: dict[str, int]):
        import regex
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(spec)
        self.cut = regex.compile(PATTERN).findall
        special = [t.content for t in encoder.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) \
            if special else None
        self.known = Lengths(encoder, frequent)

    def count(self, text: str) -> int:
        length = self.known.__getitem__
        if self.special is not None and (hits := self.special.findall(text)):
            return len(hits) + sum(sum(map(length, self.cut(part))) for part in self.special.split(text))
        return sum(map(length, self.cut(text)))


def _worker_counter(spec: str, frequent: dict[str, int]) -> PieceCounter:
    """One counter per worker process, kept from task to task."""
    home = sys.modules.setdefault("_piece_counters", types.ModuleType("_piece_counters")).__dict__
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in home:
        home[key] = PieceCounter(spec, frequent)
    return home[key]


def _counts(spec: str, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker_counter(spec, frequent.value)
        for batch in batches:
            n = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _frequent(spec: str, most: int):
    """The commonest pre-tokens of each task's share of the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = PieceCounter(spec, {}), Counter()
        for batch in batches:
            for t in batch.column("text").to_pylist():
                seen.update(p for p in counter.cut(t or "") if len(p) <= LONGEST)
        top = seen.most_common(most)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()),
                                          pa.array([c for _, c in top], pa.int64())], names=["piece", "c"])
    return run


def token_counts(docs: DataFrame, tokenizer: str | None = None, sample_rows: int = SAMPLE_ROWS,
                 frequent: int = FREQUENT, over: int = OVER) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row of ``docs``
    (``doc_id``, ``text``) as the ``tokenizers`` library counts them, without
    begin, end or padding. ``tokenizer``: path of a byte-level BPE
    ``tokenizer.json`` on the driver.

    Null texts count as empty (0 tokens). Rows are counted one by one, so
    repeated rows, null ids and an empty table need no care; further columns
    are ignored, whatever their names."""
    ship_code()
    with open(tokenizer or default_path(), encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       F.coalesce(F.octet_length(docs["text"]), F.lit(0)).cast("long").alias("n_bytes"))
    share = min(1.0, sample_rows / max(1, docs.count()))
    common = (rows.select("text").sample(share, seed=3).mapInArrow(_frequent(spec, 4 * frequent), "piece string, c long")
              .groupBy("piece").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "piece").limit(frequent).collect())
    known = PieceCounter(spec, {}).known
    table = docs.sparkSession.sparkContext.broadcast({r["piece"]: known[r["piece"]] for r in common})
    out = rows.mapInArrow(_counts(spec, table), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > over)
