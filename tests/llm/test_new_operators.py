"""Operators 11 to 13 against brute force, with nulls, empty and very long
texts, ties, repeated rows, clashing columns and empty tables."""
import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import conversations as conv
from contrail.llm.conversations import block_plans, joined, repair_digest
from contrail.llm.queries import op11_sharding, op12_periodic_runs, op13_conversation_repair
from contrail.llm.runs import periodic_runs, run_digest, runs_of, text_runs
from contrail.llm.shard_tree import SEED, Tree, numbered, shard_rows, sharded
from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


# ---- operator 11

def _xx(*values, seed=42):
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<i" if v.bit_length() < 32 and isinstance(v, Int) else "<q", v), seed)
    return seed


class Int(int):
    """Hashed as four bytes."""


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _descend(key, tree, seed=SEED):
    """Plain walk down the tree."""
    way = []
    for depth in range(3):
        weight = Counter()
        for leaf in tree.leaves:
            if list(leaf[:depth]) == way and leaf[3] > 0:
                weight[leaf[depth]] += leaf[3]
        path = _signed(_xx(Int(seed + depth), key, *map(Int, way)))
        draws = []
        for child, w in sorted(weight.items()):
            u = ((_xx(path, Int(child)) >> 11) + 0.5) / 2 ** 53
            draws.append((-math.log(u) / w, child))
        way.append(min(draws)[1])
    return tuple(way)


DOCS = [(1, "a b", "x"), (2, None, None), (None, "é", "y"), (None, "z", "y"), (1, "a b", "x"), (-5, "", "z"), (7, "w " * 50, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, shard string").repartition(3)


def test_shards_equal_a_walk_down_the_tree(spark, odd):
    tree = Tree.of(16)
    for df in (odd, spark.read.parquet(f"{SF0001}/documents.parquet")):
        for r in shard_rows(df).collect():
            way = _descend(r["doc_id"], tree)
            assert (r["region"], r["rack"], r["shard"]) == way
            assert r["grown_shard"] == _descend(r["doc_id"], tree.grown())[2] and r["grown_shard"] in (r["shard"], 16)


def test_shard_rows_have_all_rows_sizes_and_gapless_slots(spark, odd):
    for df in (odd, odd.limit(0), spark.read.parquet(f"{SF001}/documents.parquet")):
        got = shard_rows(df).collect()
        want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in df.select("doc_id", "text").collect())
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_of_shards_covers_the_table_evenly(spark):
    got = op11_sharding(spark, "/root/testdata/sf0.1").groupBy("shard").count().collect()
    counts = [r["count"] for r in got]
    assert len(counts) == 16 and sum(counts) == 10_000 and max(counts) < 1.25 * 625 and min(counts) > 0.75 * 625


def test_slots_of_hot_rows_are_cut(spark):
    rows = spark.range(5000).select((F.col("id") % 7 * (F.col("id") % 3 > 0).cast("int")).cast("int").alias("x"), F.lit(1).alias("shard"))
    got = numbered(rows, bucket_rows=2, copy_rows=100).collect()
    assert sorted(r["slot"] for r in got) == list(range(5000))
    by = defaultdict(list)
    for r in got:
        by[r["x"]].append(r["slot"])
    assert all(max(s) - min(s) + 1 == len(s) for s in by.values())


def test_weights_move_rows_only_where_they_change(spark):
    tree = Tree(((0, 0, 0, 1.0), (0, 0, 1, 3.0), (0, 1, 2, 2.0), (1, 0, 3, 1.0), (1, 1, 4, 2.0), (1, 1, 5, 0.0), (2, 0, 6, 1.0)))
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("region"))

    def at(t):
        return {r["doc"]["doc_id"]: (r["region"], r["rack"], r["shard"]) for r in sharded(docs, t).collect()}
    old, new = at(tree), at(tree.weighing(1, 5.0))
    share = Counter(s for _, _, s in old.values())
    assert share[5] == 0 and all(abs(share[s] - 2000 * w) < 350 for _, _, s, w in tree.leaves)
    moved = [(old[k], new[k]) for k in old if old[k] != new[k]]
    assert moved and all(b[0] == 0 for _, b in moved)                          # into the region that gained weight only
    assert all(b[1] == 0 for a, b in moved if a[0] == 0 and a[1] != b[1])      # inside it into the rack that gained
    assert all(b[2] == 1 for a, b in moved if a[:2] == (0, 0))                 # inside the rack into the shard
    grown = at(tree.grown(2.0))
    assert {b[2] for k, b in grown.items() if b != old[k]} == {7}
    for bad in ((), ((0, 0, 0, 0.0),), ((0, 0, 0, -1.0), (0, 0, 1, 2.0)), ((0, 0, 0, 1.0), (0, 1, 0, 1.0))):
        with pytest.raises(ValueError):
            Tree(bad)


# ---- operator 12

def _brute_runs(w, length=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(length, times * q) and not any(w[s + p:s + n] == w[s:s + n - p] for p in range(1, q)):
                out.append((s, n, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 12)), max_size=5))
def test_runs_equal_brute_force(blocks):
    w = [str(x) for b, k in blocks for x in b * k]
    want = _brute_runs(w)
    assert text_runs([b"x", " ".join(w).encode(), b""])[1][1] == want
    for length, times in ((24, 3), (4, 2), (9, 3)):
        assert sorted(runs_of(w, length, times), key=lambda r: (r[0], r[2])) == _brute_runs(w, length, times)


def _digest(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    # candidate periods first, to keep brute force short on long texts
    runs = [r for r in _brute_runs(w)] if n < 1500 else None
    if runs is None:
        return None
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_query_of_runs_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, SF0001).collect()}
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    checked = [(got[d], want) for d, t in rows if (want := _digest(d, t)) is not None]
    assert len(checked) > 150 and sum(want[0] for _, want in checked) > 5
    for a, b in checked:
        assert a == b


def test_runs_of_odd_rows(spark):
    ids = [i for i in range(-40, 200) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(1, None, 1), (2, "", 1), (None, " \x0b\t ", 1), (None, "ab " * 30, 1), (3, "x " * 23, 1), (4, "x y " * 12, 1), (4, "x y " * 12, 1),
            (5, "p q r " * 9 + "z " * 30 + "p q r " * 9, 1), *[(i, " ".join(f"w{k}" for k in range(20 + 17 * i % 90)), 1) for i in ids],
            (ids[0], "", 2), (ids[1], None, 2), (ids[2], "one", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = Counter(tuple(r) for r in run_digest(df).collect())
    assert got == Counter((d, *_digest(d, t)) for d, t, _ in rows)
    assert run_digest(df.limit(0)).count() == 0


def test_runs_of_a_text_of_megabytes(spark):
    unit = " ".join(f"w{i}" for i in range(40_000))
    text = "start " + (unit + " ") * 4 + "x " * 100_000 + "end"
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(1, 160_000, 40_000), (160_001, 100_000, 1)]
    assert row["collapsed"] == "start " + unit + " x end" and tuple(row["strongest"]) == (160_001, 100_000, 1)


# ---- operator 13

def _edits(rows, part):
    """(cost, audit, part) of all edits of ``rows``, few insertions."""
    def go(i, part, cost, audit, spare):
        if i == len(rows):
            yield cost, audit, part
        if spare:
            role, to = ("a", conv.A) if part == conv.U else ("u", conv.U)
            yield from go(i, to, cost + 2, audit + "I", spare - 1)
        if i < len(rows):
            initial, fault = rows[i]
            yield from go(i + 1, part, cost + 3, audit + "D", spare)
            if fault != conv.FORCED:
                for role, to in conv.STEPS[part].items():
                    if role == initial:
                        yield from go(i + 1, to, cost + (fault == conv.TRUNCATED), audit + "K", spare)
                    if role != "s":
                        yield from go(i + 1, to, cost + 2 + (fault == conv.TRUNCATED), audit + "R", spare)
    return go(0, part, 0, "", len(rows) + 2)


ROW = st.tuples(st.sampled_from("uuaasx"), st.sampled_from([conv.GOOD, conv.GOOD, conv.TRUNCATED, conv.FORCED]))


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, max_size=5), st.sampled_from([conv.START, conv.S, conv.U, conv.A]))
def test_plans_equal_all_edits(rows, start):
    want = {}
    for cost, audit, part in _edits(rows, start):
        want[part] = min(want.get(part, (99, "")), (cost, audit))
    assert block_plans(rows, start) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, max_size=40), st.integers(0, 40))
def test_plans_of_two_stretches_join(rows, cut):
    cut = min(cut, len(rows))
    table = {p: block_plans(rows[cut:], p) for p in range(4)}
    assert joined(block_plans(rows[:cut], conv.START), table) == block_plans(rows, conv.START)


def _repair(table):
    """conv_id -> result, by plain Python and dynamic programming on pairs."""
    groups, out = defaultdict(list), {}
    for c, t, role, text in table:
        rows = groups[c]
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            row = (t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            rows += [row] * (2 if k == 3 else 1)
    for c, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, kinds = set(), []
        for _, role, text in rows:
            body = re.sub("[\x20\x09-\x0D]+$", "", text)
            kinds.append("blank" if not body.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else
                         "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        names = [r[:1] for _, r, _ in rows]
        best = {"": (0, "", ())}  # pattern state as its last letters

        def add(to, state, way):
            if state not in to or way[:2] < to[state][:2]:
                to[state] = way

        def step(state, x):
            return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(x)

        def grow(best):
            for _ in range(2):
                for state, (cost, audit, text) in list(best.items()):
                    for x, role in (("u", "user"), ("a", "assistant")):
                        if step(state, x):
                            add(best, step(state, x), (cost + 2, audit + "I", (*text, role + ":")))
        grow(best)
        for (_, role, body), kind in zip(rows, kinds, strict=True):
            new = {}
            for state, (cost, audit, text) in best.items():
                add(new, state, (cost + 3, audit + "D", text))
                if kind in ("", "truncated"):
                    more = kind == "truncated"
                    if step(state, role[:1]):
                        add(new, step(state, role[:1]), (cost + more, audit + "K", (*text, f"{role}:{body}")))
                    for x, name in (("u", "user"), ("a", "assistant")):
                        if step(state, x):
                            add(new, step(state, x), (cost + 2 + more, audit + "R", (*text, f"{name}:{body}")))
            grow(new)
            best = new
        cost, audit, text = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(names, names[1:], strict=False)), cost, audit,
                  hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def _same(df):
    got = df.collect()
    table = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    res = repair_digest(df).collect()
    assert len(res) == len({r["conv_id"] for r in got})
    want = _repair(table)
    assert {r["conv_id"]: tuple(r)[1:] for r in res} == want
    return want


def test_query_of_repairs_equals_brute_force(spark):
    for sf in (SF0001, SF001):
        rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
        assert {r["conv_id"]: tuple(r)[1:] for r in op13_conversation_repair(spark, sf).collect()} == _repair([tuple(r) for r in rows])


def test_repairs_of_odd_rows(spark):
    rows = [(c, t, r, x, "k") for c in (None, -3, 0, 1, 2, 3) for t, r, x in [
        (None, "system", "You."), (0, None, "Hi."), (0, "user", "Hi."), (0, "user", "Hi."), (1, "assistant", None), (2, "assistant", " \n"),
        (4, "user", "cut off"), (9, "", "x."), (9, "tool", "Done!\n\n"), (10, "assistant", "No. "), (11, "Assistant", "Yes?"), (-7, "user", "Hi.")]]
    lost = next(i for i in range(100, 999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(lost, 0, "user", "gone.", "k"), (5, 1, "user", "w" * 3_000_000, "k"), (6, None, "a", "b", "k"), (6, None, "a", "c.", "k")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, late string").repartition(4)
    want = _same(df)
    assert want[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair_digest(df.limit(0)).count() == 0


def test_repair_of_one_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(conv, "BLOCK", 7)
    roles = ["user", "assistant", "user", "user", "assistant", "system", "tool"]
    rows = [(1 if i % 5 else i, i // 2, roles[i * i % 11 % 7], f"text {i % 301}" + "." * (i % 3 > 0)) for i in range(3000)]
    _same(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8))
