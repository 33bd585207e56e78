"""Operators 1 and 6 against brute force over whole texts."""
import hashlib
import random
from collections import defaultdict
from dataclasses import replace

import pytest

from contrail.llm import substring_dedup as S
from contrail.llm import suffix_dedup as B

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_words(rows, window):
    first = {}
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            k_d = d if d is not None else 1 << 70
            first[k] = min(first.get(k, 1 << 71), k_d)
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d if d is not None else 1 << 70):
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, window):
    seen = defaultdict(int)
    docs = [(d, (t or "").encode()) for d, t in rows]
    for _, b in docs:
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]] += 1
    out = []
    for d, b in docs:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60, vocab=40, length=60):
    """Random texts with shared passages, copies, periodic texts, nulls and
    repeated rows."""
    r = random.Random(seed)
    word = lambda: "w" + str(r.randrange(vocab)) + r.choice(["", "é", ","])
    passages = [[word() for _ in range(r.randrange(6, 24))] for _ in range(4)]
    rows = []
    for d in range(n):
        w = [word() for _ in range(r.randrange(length))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(passages)
        if r.random() < .15:
            w += ["from"] * r.randrange(30)
        if rows and r.random() < .2:
            w = (rows[r.randrange(len(rows))][1] or "").split()
        rows.append((d, r.choice([" ", "\n", "\t "]).join(w)))
    rows += [(None, passages[0] and " ".join(passages[0])), (n + 1, None), (n + 2, ""), rows[3], rows[3],
             (n + 3, " ".join(word() for _ in range(4000)) + " " + rows[5][1])]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("limit", [2000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(spark, seed, limit):
    rows = corpus(seed)
    rule = replace(S.RULE, window=10, gram=4, group_limit=limit, shard_items=200)
    got = sorted((tuple(r) for r in S.substring_dedup_digest(frame(spark, rows), rule).collect()), key=str)
    assert got == brute_words(rows, 10)


@pytest.mark.parametrize("limit", [2000, 3])
@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_equal_brute_force(spark, seed, limit):
    rows = corpus(seed)
    rule = replace(B.RULE, window=40, gram=9, group_limit=limit, shard_items=1500)
    got = sorted((tuple(r)[:5] for r in B.suffix_dedup(frame(spark, rows), rule).collect()), key=str)
    assert got == brute_bytes(rows, 40)


def near_copies(n, seed=9):
    """Copies of one text, each with one changed byte, some of them twice."""
    r = random.Random(seed)
    text = "".join(r.choice("abcdefgh ") for _ in range(160))
    out = []
    for d in range(n):
        at = r.randrange(160)
        out.append((d, text[:at] + r.choice("XYZ") + text[at + 1:]))
    return out


@pytest.mark.parametrize("limit", [2, 7, 40])
def test_near_copies_over_many_shards_equal_brute_force(spark, limit):
    rows = near_copies(150)
    rule = replace(B.RULE, window=40, gram=9, group_limit=limit, shard_items=1500)
    got = sorted((tuple(r)[:5] for r in B.suffix_dedup(frame(spark, rows), rule).collect()), key=str)
    assert got == brute_bytes(rows, 40)


def test_a_shard_hands_on_each_window_once():
    bodies = [b.encode() for _, b in near_copies(30)]
    seen = set()
    for body, (_, first) in zip(bodies, B.repeated_windows(bodies, 40), strict=True):
        for i, new in enumerate(first):
            assert new == (body[i:i + 40] not in seen)
            seen.add(body[i:i + 40])


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.substring_dedup_digest(empty).count() == 0
    assert B.suffix_dedup(empty).count() == 0
    assert S.substring_dedup(empty).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, 6, "x"), (2, None, 7, 8, "y")],
                                "doc_id long, text string, n_words int, key int, kept_text string")
    got = sorted(map(tuple, S.substring_dedup(odd).collect()))
    assert got == [(1, "a b", 6, 2, 0, None), (2, None, 8, 0, 0, None)]
    assert B.suffix_dedup(odd).count() == 2


def test_kept_text_of_general_operator(spark):
    text = " ".join(f"x{i}" for i in range(12))
    rule = replace(S.RULE, window=10, gram=4)
    df = frame(spark, [(1, text), (2, "start " + text + " end"), (3, "alone")])
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in S.substring_dedup(df, rule).collect()}
    assert got == {1: (0, None), 2: (12, "start end"), 3: (0, None)}
