"""Operator 9, benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens (runs of letters, digits and bytes above
127, case folded) in which numbers, units after numbers, and capitalised
words inside a sentence are replaced by the placeholders of their type.
Windows of ``window`` such tokens with enough literal words are hashed and
hash-joined with the windows of the benchmark items; an item shorter than
the window is one window. A joined window counts only if its slots are
consistent: the same value of the item always met the same value of the
document. So a question with other numbers or names is still caught, and a
text that merely looks alike is not. Every window is also looked for by its
folded words alone, whatever their capitals and the punctuation around them,
and is seen if either form joins. A document is reported when the windows
seen cover at least ``coverage`` of an item's windows with enough literal
words, or those seen word by word as much of all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import BASE, RangeHash, Words, batch_of, doc_id_of, identified, identity, stored, text_chunks, with_plain_names

WINDOW = 8
LITERALS = 5          # of a window; fewer leave too little to tell
COVERAGE = 0.5
PREFILTER_KEYS = 1_000_000  # benchmark windows whose hashes (8 bytes each) tasks may hold

SEP = np.ones(256, dtype=bool)
for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    SEP[lo:hi] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_STOP = np.zeros(256, dtype=np.int64)
_STOP[list(b".!?:\n")] = 1
UNITS = ("mm cm m km in inch inches ft feet yd mile miles mg g kg lb lbs oz ml l liter liters s sec second seconds "
         "min minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars "
         "euro euros usd eur hz khz mhz ghz w kw v a j kj cal kcal mph kph").split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (11, 13, 17))
PLAIN_BASE = BASE ^ 0x5DEECE66E  # hashes of folded words are no hashes of templates

_HIT = pa.schema([("h", pa.int64()), ("_id", pa.int64()), ("_th", pa.int64()), ("at", pa.int64()),
                  ("windows", pa.int64()), ("size", pa.int64()), ("plain", pa.bool_()), ("enough", pa.bool_()),
                  ("slots", pa.list_(pa.binary()))])
_HIT_DDL = ("h long, _id long, _th long, at long, windows long, size long, plain boolean, enough boolean, "
            "slots array<binary>")


def _units() -> np.ndarray:
    return np.sort(Words([u.encode() for u in UNITS]).hash)


def _folded(text: bytes) -> bytes:
    """Case folded; no token appears, goes or is cut by it. A-Z is left to FOLD."""
    if text.isascii():
        return text
    return text.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")


def template(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, code of each word, whether it is a placeholder)."""
    folded = [_folded(t) for t in texts]
    w = Words(folded, sep=SEP, fold=FOLD)
    if not len(w.starts):
        return w, w.hash, np.zeros(0, dtype=bool)
    # the words as written, one by one those of w
    r = w if all(x is y for x, y in zip(folded, texts, strict=True)) else Words(texts, sep=SEP, hashes=False)
    code, head = w.hash.copy(), r.raw[r.starts]
    stops = np.concatenate([[0], np.cumsum(_STOP[r.raw])])
    before = np.concatenate([[0], r.ends[:-1]])
    opens = stops[r.starts] > stops[before]
    opens[w.first[:-1][w.counts > 0]] = True
    name = (head >= 65) & (head <= 90) & ~opens
    for i in np.flatnonzero((head >= 128) & ~opens).tolist() if r is not w else ():
        first = r.raw[r.starts[i]:min(r.starts[i] + 4, r.ends[i])].tobytes().decode("utf-8", "ignore")[:1]
        name[i] = first.isupper() or first.istitle()
    number = (head >= 48) & (head <= 57)
    units = _units()
    slot = np.minimum(np.searchsorted(units, w.hash), len(units) - 1)
    unit = np.zeros(len(code), dtype=bool)
    unit[1:] = (units[slot] == w.hash)[1:] & number[:-1] & (w.doc[1:] == w.doc[:-1])
    code[name], code[number], code[unit] = NAME, NUMBER, UNIT
    return w, code, name | number | unit


def _windows(window: int, literals: int, keys, short=None):
    """Hashed windows with their slots, of templates with enough literal
    words and of the folded words alone. A text shorter than ``window`` is
    one window; with ``short`` (lengths under ``window``), all runs of these
    lengths are windows too, and a shorter text is none by itself. ``keys``:
    sorted hashes to look for, None for all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if keys is None else keys.value

        def known(h: np.ndarray) -> np.ndarray:
            if wanted is None:
                return np.ones(len(h), dtype=bool)
            slot = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
            return wanted[slot] == h if len(wanted) else np.zeros(len(h), dtype=bool)

        for batch, texts in text_chunks(batches):
            w, code, held = template(texts)
            if not len(code):
                continue
            buf = w.buf.tobytes()
            ids, ths = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
            forms = RangeHash(code), RangeHash(w.hash, PLAIN_BASE)
            literal = np.concatenate([[0], np.cumsum(~held)])
            for length in [window, *(short or [])]:
                room = np.maximum(w.counts - length + 1, 0)
                if short is None:
                    room = np.where(w.counts < length, np.minimum(w.counts, 1), room)
                doc = np.repeat(np.arange(len(texts)), room)
                at = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
                start = w.first[doc] + at
                end = start + np.minimum(length, w.counts[doc])
                enough = literal[end] - literal[start] >= np.minimum(literals, np.maximum(end - start - 1, 1))
                for plain, form in enumerate(forms):
                    h = form.of(start, end).view(np.int64)
                    hit = np.flatnonzero(known(h) & (enough | bool(plain)))
                    if plain and short is not None and len(hit):  # one place of a text is enough
                        order = hit[np.lexsort((h[hit], doc[hit]))]
                        new = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                        hit = order[np.concatenate([[True], new])]
                    if not len(hit):
                        continue
                    slots = [[] if plain else [buf[w.starts[x]:w.ends[x]] for x in range(s, e) if held[x]]
                             for s, e in zip(start[hit].tolist(), end[hit].tolist(), strict=True)]
                    yield batch_of(_HIT, h=h[hit], _id=ids[doc[hit]], _th=ths[doc[hit]], at=at[hit],
                                   windows=room[doc[hit]], size=(end - start)[hit],
                                   plain=np.full(len(hit), bool(plain)), enough=enough[hit], slots=slots)
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS,
          coverage: float = COVERAGE) -> DataFrame:
    """``_id, _th, item_id, share`` of every document and benchmark item it
    repeats. ``docs``: doc_id, text; ``benchmark``: item_id, text."""
    items = identified(benchmark.select(benchmark["item_id"].alias("doc_id"), benchmark["text"]))
    theirs = stored(items.mapInArrow(_windows(window, literals, None), _HIT_DDL).select(
        "h", F.col("_id").alias("item_id"), F.col("_th").alias("item_th"), F.col("at").alias("item_at"),
        "windows", "size", "plain", "enough", F.col("slots").alias("theirs")), "items")
    short = sorted(r["size"] for r in theirs.filter(F.col("size") < window).select("size").distinct().collect())
    # a prefilter only: the join below decides either way
    few = theirs.select("h").distinct().limit(PREFILTER_KEYS + 1).toPandas()["h"].to_numpy()
    keys = None
    if len(few) <= PREFILTER_KEYS:
        keys = docs.sparkSession.sparkContext.broadcast(np.sort(few.astype(np.int64)))
    ours = identified(docs).mapInArrow(_windows(window, literals, keys, short), _HIT_DDL).select(
        "h", "_id", "_th", F.col("slots").alias("ours"))
    # windows of items as counted: those with enough literal words, and all
    counted = theirs.groupBy("item_id", "item_th").agg(
        F.countDistinct(F.when(F.col("enough"), F.col("item_at"))).alias("usable"), F.max("windows").alias("all"))
    met = F.arrays_zip("theirs", "ours")
    same = ours.join(theirs, "h").filter(
        (F.size("theirs") == F.size("ours"))
        & (F.size(F.array_distinct(met)) == F.size(F.array_distinct("theirs"))))
    item = ["_id", "_th", "item_id", "item_th"]
    found = (same.groupBy(*item, "item_at").agg(F.max("plain").alias("plain"), F.max("enough").alias("enough"))
             .groupBy(*item).agg(F.count_if("enough").alias("seen"), F.count_if("plain").alias("worded")))
    # without usable windows the first share is null, and the other decides
    first = F.when(F.col("usable") > 0, F.col("seen") / F.col("usable"))
    return (found.join(counted, ["item_id", "item_th"])
            .select("_id", "_th", "item_id", F.greatest(first, F.col("worded") / F.col("all")).alias("share"))
            .filter(F.col("share") >= coverage))


def contaminated(docs: DataFrame, benchmark: DataFrame, **setting) -> DataFrame:
    """One row per contaminated document: doc_id, n_items, item_ids (sorted)
    and share (of the item repeated most). Clean documents have no row.

    Null and empty texts hold no window. Repeated rows are one document. An
    empty benchmark finds nothing. Further columns are ignored, whatever
    their names; null ids are kept as null."""
    got = leaks(docs, benchmark, **setting)
    return got.groupBy("_id", "_th").agg(
        F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.max("share").alias("share")).select(doc_id_of(), "n_items", "item_ids", "share")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **setting) -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item, with all their
    columns, whatever their names. Null and empty texts stay, and so does
    every row if the benchmark is empty; repeated rows stay or go together."""
    def clean(d: DataFrame) -> DataFrame:
        bad = leaks(d, benchmark, **setting).select("_id", "_th").distinct()
        rows = d.select(*[d[c] for c in d.columns], *identity(d))
        return rows.join(bad, ["_id", "_th"], "left_anti").select(*d.columns)
    return with_plain_names(docs, clean)
