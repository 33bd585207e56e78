"""Operator 2: what a run leaves on disk, and the packing that keeps it small."""
import os

import numpy as np

from contrail.llm.lm_score import (_groups, _lowest, _packed, _pressed, _unpacked, _unpressed,
                                   cross_entropy_difference)
from contrail.session import ensure_checkpoint_dir


def _bytes(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    tops = [str(d) for d in local] + [ensure_checkpoint_dir(spark).removeprefix("file:")]
    return sum(os.path.getsize(os.path.join(at, f)) for top in tops for at, _, files in os.walk(top) for f in files)


def test_a_run_takes_at_most_four_times_its_text_of_disk(spark):
    r = np.random.default_rng(5)
    texts = [" ".join(f"w{x:x}" for x in r.zipf(1.2, 600) % 200_000) for _ in range(800)]
    size = sum(map(len, texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).localCheckpoint()
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(800)], "doc_id long, quality int")
    before = _bytes(spark)
    assert cross_entropy_difference(docs, lab).selectExpr("count(score)").first()[0] == 800
    assert _bytes(spark) - before < 4 * size


def test_packed_numbers_come_back():
    for x in ([], [0], [0, 255], [1, 256, 70_000], [2**64 - 1, 0]):
        x = np.array(x, dtype=np.uint64)
        assert (_unpacked(_packed(x), len(x)) == x).all()
    assert len(_packed(np.ones(10))) == 10


def test_groups_grow_no_faster_than_the_text():
    n = [_groups(s, 16 << 20) for s in (0, 1, 1 << 22, 10 << 22, 1 << 30, 32 << 30)]
    assert n == [1, 1, 1, 10, 256, 2048]


def test_a_score_of_chunks_and_ranges_equals_one_of_a_single_group(spark, monkeypatch):
    from contrail.llm import lm_score
    r = np.random.default_rng(6)
    rows = [(i if i % 7 else None, " ".join(f"w{x}" for x in r.zipf(1.4, 40) % 300)) for i in range(120)]
    rows += [rows[3], rows[3], (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    one = sorted(map(tuple, cross_entropy_difference(docs, lab).collect()), key=str)
    monkeypatch.setattr(lm_score, "_groups", lambda size, most: 7 if most == lm_score.CHUNK_MOST else 5)
    many = sorted(map(tuple, cross_entropy_difference(docs, lab).collect()), key=str)
    assert len(one) == len(rows) and [x[:2] for x in one] == [x[:2] for x in many]
    assert np.allclose([x[2:] for x in one], [x[2:] for x in many], atol=3e-6)


def test_pressed_numbers_come_back():
    r = np.random.default_rng(7)
    for x in ([], [0], [3], [0] * 50, [1] * 500, [1, 256, 70_000], [2**64 - 1, 0], np.diff(np.sort(
            r.integers(0, 2**63, 3_000).astype(np.uint64)), prepend=np.uint64(0)), r.zipf(1.3, 2_000) % 100_000):
        x = np.array(x, dtype=np.uint64)
        assert (_unpressed(_pressed(x), len(x)) == x).all()
    # one count in ten differs from 1
    assert len(_pressed(np.where(np.arange(2_000) % 10, 1, 2))) < 400


def test_the_lowest_hash_of_a_range():
    for ranges in (1, 3, 7, 204, 3_000):
        for k in {0, 1 % ranges, ranges // 2, ranges - 1}:
            low = int(_lowest(k, ranges))
            assert (low >> 32) * ranges >> 32 == k
            assert not low or (low - 1 >> 32) * ranges >> 32 == k - 1


def test_texts_are_dealt_once_and_nothing_is_stored(spark, tmp_path):
    rows = [(i, f"one two w{i} w{i % 9} three") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    lab = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {*os.listdir(top)}
    df = cross_entropy_difference(spark.read.parquet(f"{tmp_path}/docs"), lab)
    assert len(df.collect()) == 200
    assert {*os.listdir(top)} == before
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reused = [line for line in plan.splitlines() if "ReusedExchange" in line]
    assert len(reused) == 1 and "text#" in reused[0]


def test_chunks_that_ask_few_ranges_know_all_totals(spark, monkeypatch):
    from contrail.llm import lm_score
    rows = [(i, f"w{i // 2}") for i in range(40)] + [(40, None), (41, " "), (None, "w3 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int")
    one = sorted(map(tuple, cross_entropy_difference(docs, lab).collect()), key=str)
    monkeypatch.setattr(lm_score, "_groups", lambda size, most: 19 if most == lm_score.CHUNK_MOST else 6)
    assert sorted(map(tuple, cross_entropy_difference(docs, lab).collect()), key=str) == one
