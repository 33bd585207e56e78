"""Operator 4 against all pairs by brute force."""
import random
import re
from dataclasses import replace

import pytest

from contrail.llm.ngram_join import Setting, ngram_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, k=5):
    def shingles(t):
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= 80 * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    ids = [d if d is not None else (1 << 63) - 1 for d, _ in rows]
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), 1 << 64), ids[i])
    return sorted(((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))), key=str)


def corpus(seed, n=80):
    r = random.Random(seed)
    word = lambda: r.choice(["A", "b", "Ç"]) + str(r.randrange(500))
    common = [word() for _ in range(40)]
    rows = []
    for d in range(n):
        if rows and r.random() < .6:
            w = (rows[r.randrange(len(rows))][1] or "").split()
            for _ in range(r.randrange(3)):
                if w:
                    w[r.randrange(len(w))] = word()
            if r.random() < .3:
                w = w[:r.randrange(len(w) + 1)]
        else:
            w = [word() for _ in range(r.randrange(120))]
            if r.random() < .5:
                w += common
        rows.append((d, r.choice([" ", "\n"]).join(w)))
    return rows + [(None, "a b c"), (None, rows[2][1]), (n, None), (n + 1, ""), (n + 2, "A B c"), rows[4], (n + 3, "one")]


@pytest.mark.parametrize("limit", [1000, 4])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_brute_force(spark, seed, limit):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in ngram_groups(df, replace(Setting(), block_limit=limit)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert ngram_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, 1), (2, "A  b", 6, 2)], "doc_id long, text string, sid int, token int")
    assert sorted(map(tuple, ngram_groups(odd).collect())) == [(1, 1, 1), (2, 1, 1)]


def test_more_text_has_more_cells_and_the_same_groups(spark, monkeypatch):
    from contrail.llm import ngram_join as J
    monkeypatch.setattr(J, "CELLS", 1 << 4)
    monkeypatch.setattr(J, "MOST_CELLS", 1 << 12)
    monkeypatch.setattr(J, "_PIECE", 1 << 3)
    monkeypatch.setattr(J, "_AT_ONCE", 100)
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    size = sum(len((t or "").encode()) for _, t in rows)
    cells = J.with_cells(docs, J.Setting()).cells
    assert cells / 2 * J.CELL_BYTES < size <= cells * J.CELL_BYTES and cells > 1 << 4
    assert J.with_cells(docs.limit(0), J.Setting()).cells == 1 << 4
    monkeypatch.setattr(J, "CELL_BYTES", 1)
    assert J.with_cells(docs, J.Setting()).cells == 1 << 12
    assert J.with_cells(docs, J.Setting(cells=7)).cells == 7
    for cells in (None, 1, 7, 1 << 12):  # crowded cells cost work, no rows
        assert sorted(((r[0], r[1], r[2]) for r in ngram_groups(docs, J.Setting(cells=cells)).collect()), key=str) == brute(rows)


def test_cell_counts_of_any_size_are_packed_and_read_back():
    import numpy as np

    from contrail.llm import ngram_join as J
    for top in (0, 255, 256, 65_535, 65_536, 1 << 40):
        counts = np.array([0, 1, top], dtype=np.int64)
        assert J._inflated(J._deflated(counts)).tolist() == counts.tolist()
