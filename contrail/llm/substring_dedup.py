"""Operator 1, substring dedup by suffix automata.

Reference shards are cut out of the corpus by :mod:`contrail.llm.repeats`:
each holds, once, every distinct stretch of text that shares a key with
another document, and its size is bounded. A suffix automaton of a shard
carries in each state the smallest document id of the strings it stands
for. Streaming a stretch through the automaton gives, at every word, the
longest match that ends there (its matching statistics); where it reaches
the window length, the state on the suffix-link path that stands for the
window tells which document had it first. The automaton of a shard lives in
the task that streams the shard's documents; a popular key is split over
several such tasks and what they leave open is merged by window hash.
"""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import NULL_ID, doc_id_of, identity, with_plain_names, without_columns
from contrail.llm.repeats import Rule, ranges_where, remove_repeats

WINDOW = 50       # words
GRAM = 8         # words hashed for a key
SHARD_WORDS = 60_000


class SuffixAutomaton:
    """Generalised suffix automaton of sequences with owners; ``owner`` of a
    state is the least owner over all occurrences of its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list[int] = [NULL_ID]

    def _state(self, length: int, edges: dict, link: int, owner: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(owner)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        """Copy of ``q`` for the strings up to one longer than ``p``'s."""
        nxt, link = self.next, self.link
        twin = self._state(self.length[p] + 1, nxt[q].copy(), link[q], NULL_ID)
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        link[q] = twin
        return twin

    def add(self, items: list, owner: int) -> None:
        nxt, link, length, owners = self.next, self.link, self.length, self.owner
        last, size = 0, len(nxt)
        for c in items:
            q = nxt[last].get(c)
            if q is not None:  # known from an earlier sequence
                if length[q] == length[last] + 1:
                    last = q
                else:
                    last = self._split(last, c, q)
                    size += 1
                if owner < owners[last]:
                    owners[last] = owner
                continue
            nxt.append({})
            length.append(length[last] + 1)
            owners.append(owner)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = size
                p = link[p]
            last = size
            size += 1
            if p < 0:
                link.append(0)
                continue
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link.append(q)
            else:
                link.append(0)  # the copy takes the next number
                link[last] = self._split(p, c, q)
                size += 1

    def finish(self) -> None:
        """Hand owners up the suffix links, longest strings first."""
        owner, link = self.owner, self.link
        for v in np.argsort(-np.array(self.length), kind="stable").tolist():
            p = link[v]
            if p >= 0 and owner[v] < owner[p]:
                owner[p] = owner[v]

    def first_owner(self, items: list, window: int) -> list[int]:
        """Least owner of each window of ``items``; NULL_ID, which no
        document's id is greater than, where the matching statistics stay
        below the window length."""
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        out, v, matched = [], 0, 0
        for i, c in enumerate(items):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            while v and length[link[v]] >= window:
                v = link[v]
                matched = length[v]
            if i >= window - 1:
                out.append(owner[v] if matched >= window else NULL_ID)
        return out


def match_words(bodies: list[bytes], places: dict, window: int):
    """For each distinct stretch: (place, (starts, ends, undecided)) of
    every place; ranges are of window starts."""
    sam = SuffixAutomaton()
    lists = [b.split(b" ") for b in bodies]
    gc.disable()  # its many small dictionaries hold no cycles
    try:
        for body, items in zip(bodies, lists, strict=True):
            sam.add(items, min(p[0] for p in places[body]))
    finally:
        gc.enable()
    sam.finish()
    for body, items in zip(bodies, lists, strict=True):
        first = np.array(sam.first_owner(items, window), dtype=np.int64)
        known: dict[int, tuple] = {}
        verdicts = []
        for place in places[body]:
            doc = place[0]
            if doc not in known:
                gone = first < doc
                known[doc] = (*ranges_where(gone), np.flatnonzero(~gone).tolist() if place[3] else ())
            verdicts.append((place, known[doc]))
        yield verdicts


RULE = Rule(window=WINDOW, gram=GRAM, words=True, across=True, match=match_words, shard_items=SHARD_WORDS)


def substring_dedup(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text`` needed) with ``n_words``,
    ``n_removed``, ``kept_text`` (null where nothing was removed) added.

    A word goes if a window of ``rule.window`` words that covers it also
    starts in a document with a smaller id; ids may be negative. Null and
    empty texts have no words. Rows that repeat a ``doc_id`` never remove from
    each other; a null id counts as larger than all others. An empty table
    gives no rows. Input columns named like the added ones are replaced, other
    columns are kept, whatever their names."""
    docs = without_columns(docs, ("n_words", "n_removed", "kept_text"))
    return with_plain_names(docs, lambda d: _joined(d, *remove_repeats(d, rule)))


def _joined(docs: DataFrame, summary: DataFrame, changed: DataFrame) -> DataFrame:
    added = changed.select("_id", "_th", "n_removed", F.col("kept").cast("string").alias("kept_text"))
    counts = summary.select("_id", "_th", F.col("n").alias("n_words")).dropDuplicates(["_id", "_th"])
    rows = docs.select(*[docs[c] for c in docs.columns], *identity(docs))
    return (rows.join(counts, ["_id", "_th"]).join(added, ["_id", "_th"], "left")
            .select(*docs.columns, "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    "kept_text"))


def substring_dedup_digest(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row: the digest of
    the kept words, without moving unchanged texts."""
    summary, changed = remove_repeats(docs, rule)
    new = changed.select("_id", "_th", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return summary.join(new, ["_id", "_th"], "left").select(
        doc_id_of(), F.col("n").alias("n_words"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
