"""Operator 10, license scans by template-markup matching.

A template is a license text with markup: ``<<opt ...>>`` may be missing,
``<<var n>>`` stands for one to n words of any wording, ``<<a|b>>`` is one of
the given wordings. Each template is compiled into a token automaton; all of
them run as one non-deterministic automaton over the words of a text, and a
place is accepted where the mandatory wording matches word for word. Only
texts that hold the first mandatory word pair of a template are walked; the
pairs and the base phrases are found in word hashes, whole chunks at a time,
and every hash hit is compared with the words themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import RangeHash, Words, batch_of, text_chunks
from contrail.session import ship_code

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices and whole texts of common licenses, with markup for what
#: may be missing or differ; their label comes first.
TEMPLATES = [
    ("mit-notice", "released under the <<opt terms of the>> mit license"),
    ("mit-notice", "licensed under the <<opt terms of the>> mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this <<software|work>> "
                 "and associated documentation files <<opt the software>> to deal in the software without restriction "
                 "including without limitation the rights to use copy modify merge publish distribute sublicense and or "
                 "sell copies of the software and to permit persons to whom the software is furnished to do so subject "
                 "to the following conditions the above copyright notice and this permission notice <<opt including the "
                 "next paragraph>> shall be included in all copies or substantial portions of the software the software "
                 "is provided as is without warranty of any kind express or implied including but not limited to the "
                 "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
                 "<<the authors or copyright holders|<<var 12>>>> be liable for any claim damages or other liability "
                 "whether in an action of contract tort or otherwise arising from out of or in connection with the "
                 "software or the use or other dealings in the software"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 <<opt the license>>"),
    ("gpl-notice", "licensed under the <<opt terms of the>> gnu general public license <<opt version <<var 1>>>>"),
    ("gpl-notice", "under the terms of the gnu <<opt lesser>> general public license as published by the free software "
                   "foundation either version <<var 2>> of the license or <<opt at your option>> any later version"),
    ("cc-by-notice", "licensed under <<opt a>> <<cc|creative commons>> by <<opt nc>> <<opt sa|nd>> <<opt 4 0>>"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met <<opt 1>> redistributions of source code must retain "
                 "the above copyright notice this list of conditions and the following disclaimer <<opt 2>> "
                 "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                 "the following disclaimer in the documentation and or other materials provided with the distribution "
                 "<<opt <<opt 3>> neither the name of <<var 12>> nor the names of <<its|any|<<var 4>>>> contributors may "
                 "be used to endorse or promote products derived from this software without specific prior written "
                 "permission>> this software is provided by <<the copyright holders and contributors|<<var 12>>>> as is "
                 "and any express or implied warranties including but not limited to the implied warranties of "
                 "merchantability and fitness for a particular purpose are disclaimed in no event shall <<the copyright "
                 "<<holder|holders|owner>> or contributors|<<var 12>>>> be liable for any direct indirect incidental "
                 "special exemplary or consequential damages including but not limited to procurement of substitute "
                 "goods or services loss of use data or profits or business interruption however caused and on any "
                 "theory of liability whether in contract strict liability or tort including negligence or otherwise "
                 "arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc-text", "permission to use copy modify and <<opt or>> distribute this software for any purpose with or "
                 "without fee is hereby granted provided that the above copyright notice and this permission notice "
                 "appear in all copies the software is provided as is and <<the author|<<var 8>>>> disclaims all "
                 "warranties with regard to this software including all implied warranties of merchantability and "
                 "fitness in no event shall <<the author|<<var 8>>>> be liable for any special direct indirect or "
                 "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in "
                 "an action of contract negligence or other tortious action arising out of or in connection with the "
                 "use or performance of this software"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license <<opt v 2 0>>"),
    ("copyright-notice", "copyright <<opt c>> <<var 6>> all rights reserved"),
]

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SEP = np.zeros(256, dtype=bool)
for lo, hi in ((0x00, 0x30), (0x3A, 0x61), (0x7B, 0x80)):
    SEP[lo:hi] = True


class Automaton:
    """Token automaton with empty moves; ``None`` on an edge is any word."""

    def __init__(self):
        self.edges: list[list[tuple[str | None, int]]] = [[]]
        self.empty: list[list[int]] = [[]]
        self.labels: dict[int, str] = {}

    def _new(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _word(self, at: int, word: str | None) -> int:
        new = self._new()
        self.edges[at].append((word, new))
        return new

    def _parts(self, at: int, tree: list) -> int:
        for part in tree:
            if isinstance(part, str):
                at = self._word(at, part)
            elif part[0] == "var":
                end = self._new()
                for _ in range(part[1]):
                    at = self._word(at, None)
                    self.empty[at].append(end)
                at = end
            else:
                end = self._new()
                for choice in part[1]:
                    self.empty[self._parts(at, choice)].append(end)
                if part[0] == "opt":
                    self.empty[at].append(end)
                at = end
        return at

    def add(self, label: str, template: str) -> None:
        start = self._new()
        self.empty[0].append(start)
        self.labels[self._parts(start, parse(template))] = label

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def accept(self, words: list[str], at: int) -> list[tuple[str, int]]:
        """(label, end) of the longest match of each label that starts at
        word ``at``."""
        found: dict[str, int] = {}
        states = self.closure([0])
        while True:
            for s in states:
                if s in self.labels:
                    found[self.labels[s]] = at
            if at == len(words) or not states:
                return sorted(found.items())
            states = self.closure({t for s in states for w, t in self.edges[s] if w is None or w == words[at]})
            at += 1


def parse(template: str) -> list:
    """Words, ("opt", choices), ("any", choices) and ("var", n)."""
    tokens = re.findall(r"<<|>>|\||[^\s<>|]+", template)

    def level(i: int) -> tuple[list, int]:
        choices, cur = [], []
        kind, n = "any", 0
        if i and tokens[i - 1] == "<<" and tokens[i] in ("opt", "var"):
            kind, i = tokens[i], i + 1
        while i < len(tokens) and tokens[i] != ">>":
            if tokens[i] == "<<":
                part, i = level(i + 1)
                cur.append(part)
            elif tokens[i] == "|":
                choices.append(cur)
                cur = []
            elif kind == "var":
                n = int(tokens[i])
            else:
                cur.append(tokens[i])
            i += 1
        return (("var", n) if kind == "var" else (kind, [*choices, cur])), i

    out, i = [], 0
    while i < len(tokens):
        if tokens[i] == "<<":
            part, i = level(i + 1)
            out.append(part)
        else:
            out.append(tokens[i])
        i += 1
    return out


def openings(tree: list) -> list[tuple[str, str]]:
    """The word pairs a match can start with; templates open with two
    mandatory words or one before a choice."""
    first = tree[0]
    pairs, i = [], 1
    while True:
        part = tree[i]
        if isinstance(part, str):
            return [*pairs, (first, part)]
        if part[0] == "var":
            return [*pairs, (first, None)]
        pairs += [(first, c[0]) for c in part[1]]
        if part[0] != "opt":
            return pairs
        i += 1


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                  ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                  ("score", pa.float64()), ("spans", pa.string())])
_OUT_DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
            "labels string, score double, spans string")


def _word_hashes(words: list[str]) -> np.ndarray:
    return Words([w.encode() for w in words]).hash


def _scan(templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton()
        pairs: set[tuple[str, str | None]] = set()
        for label, text in templates:
            machine.add(label, text)
            pairs.update(openings(parse(text)))
        singles = np.array(sorted({int(_word_hashes([a])[0]) for a, b in pairs if b is None}), dtype=np.uint64)
        opens = np.array(sorted({int(RangeHash(_word_hashes([a, b])).grams(2)[0]) for a, b in pairs if b is not None}),
                         dtype=np.uint64)
        phrases = [(p.split(), label) for p, label in BASE.items()]
        keys = [(words, label, RangeHash(_word_hashes(words)).grams(len(words))[0]) for words, label in phrases]
        for batch, texts in text_chunks(batches):
            w = Words(texts, sep=SEP, fold=FOLD)
            rh = RangeHash(w.hash)
            base: dict[int, list[tuple[int, str]]] = {}
            starts: dict[int, list[int]] = {}

            def word(i, w=w):
                return w.buf[w.starts[i]:w.ends[i]].tobytes().decode("utf-8", "replace")

            for words, label, key in keys:
                k = len(words)
                if len(w.hash) < k:
                    continue
                for i in np.flatnonzero(rh.grams(k) == key).tolist():
                    d = int(w.doc[i])
                    if w.doc[i + k - 1] == d and [word(i + x) for x in range(k)] == words:
                        base.setdefault(d, []).append((i - int(w.first[d]), label))
            hits = [np.flatnonzero(np.isin(w.hash, singles))]
            if len(w.hash) > 1:
                two = np.flatnonzero(np.isin(rh.grams(2), opens))
                hits.append(two[w.doc[two] == w.doc[two + 1]])
            for i in np.unique(np.concatenate(hits)).tolist():
                starts.setdefault(int(w.doc[i]), []).append(i - int(w.first[w.doc[i]]))
            rows = []
            for d in range(len(texts)):
                places, more = sorted(base.get(d, [])), []
                if d in starts:
                    words = [word(i) for i in range(int(w.first[d]), int(w.first[d + 1]))]
                    more = [(s, e, label) for s in starts[d] for label, e in machine.accept(words, s)]
                n = int(w.counts[d])
                mine = sorted({label for _, label in places})
                all_ = sorted({*mine, *(label for _, _, label in more)})
                spans = ",".join(f"{label}:{s}-{e}" for s, e, label in more)
                rows.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None,
                             ",".join(mine), ",".join(all_), 1.0 if more else 0.5 if places else 0.0, spans))
            cols = list(zip(*rows, strict=True))
            yield batch_of(_OUT, doc_id=batch.column("doc_id"), **dict(zip(_OUT.names[1:], cols, strict=True)))
    return run


def license_scan(docs: DataFrame, templates=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans of every row of ``docs`` (``doc_id``, ``text``).

    Words are runs of a-z, 0-9 and characters beyond ASCII after folding
    A-Z. ``n_base`` counts all places of the base phrases, first_word and
    last_word are the smallest and largest start (null if none). ``labels``
    adds those of accepted templates; ``spans`` lists their places as
    label:start-end. score is 1 if a template is accepted, 0.5 if only a base
    phrase stands there, else 0. Null and empty texts have no words. Rows are
    scanned one by one; repeated rows, null ids, empty tables and further
    columns, whatever their names, make no difference."""
    ship_code()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(_scan(templates or TEMPLATES), _OUT_DDL).select(*[F.col(c) for c in _OUT.names])
