"""Rows of all kinds through operators and pipeline stages: columns with
clashing names, negative ids, texts of megabytes, empty tables."""
import hashlib
import random

import pytest

import corpus_pipeline as P
from contrail.llm.licenses import license_scan
from contrail.llm.mixing import mixture
from contrail.llm.ngram_join import ngram_groups
from contrail.llm.quality import quality_scores
from contrail.llm.substring_dedup import substring_dedup, substring_dedup_digest
from contrail.llm.suffix_dedup import suffix_dedup
from contrail.llm.token_counts import token_counts
from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"
CLASHES = ["_id", "_th", "__id", "__th", "__i", "__t", "n_words", "n_removed", "kept_text", "score", "Predicted", "__score", "size", "taken",
           "shards", "s", "block", "n", "group", "key", "share", "item_id", "spans", "x", "a.b", "column_1", "copy", "Words", "shard", "place"]
ADDED = ("copy", "words", "shard", "place")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


def _key(df, *more):
    return sorted(map(str, df.select("doc_id", "text", "lang", "source", "n_chars", *more).collect()))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_keep_columns_of_any_name(spark, docs, name, stage):
    named = docs.select("*", *[F.concat(F.lit(c + "-"), F.col("doc_id")).alias(c) for c in CLASHES])
    last = stage is P.STAGES[-1][1]
    plain, got = stage(spark, docs, SF0001), stage(spark, named, SF0001)
    assert _key(plain, *(ADDED if last else ())) == _key(got, *(ADDED if last else ()))
    kept = [c for c in CLASHES if not last or c.lower() not in ADDED]
    assert got.columns == [*docs.columns, *kept, *(ADDED if last else ())]
    wrong = [F.col(f"`{c}`") != F.concat(F.lit(c + "-"), F.col("doc_id")) for c in kept]
    assert got.filter(F.exists(F.array(*wrong), lambda x: x)).isEmpty() and got.count() > 0


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_take_an_empty_table_and_odd_rows(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SF0001).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (-3, "", "en", "s", 0), (-3, " \t", "en", None, 2),
                                 (4, "one two three", "en", "s", 13), (4, "one two three", "en", "s", 13)], docs.schema)
    got = stage(spark, odd, SF0001)
    assert got.count() <= 15 and got.filter("text IS NULL").count() <= 1
    if stage in (P.near_duplicates, P.repeated_passages, P.benchmark_leaks):
        assert {r["text"] for r in got.collect()} == {None, "", " \t", "one two three"}


def test_substring_dedup_takes_negative_ids(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(-5, "a " + passage), (-9, passage + " b"), (3, "c " + passage + " d"), (None, passage + " e"), (-(1 << 63), "f " + passage)]
    got = {r["doc_id"]: r for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["n_removed"] for k, r in got.items()} == {-5: 60, -9: 60, 3: 60, None: 60, -(1 << 63): 0}
    assert got[-5]["kept_text"] == "a" and got[3]["kept_text"] == "c d" and got[None]["kept_text"] == "e"
    digest = {r["doc_id"]: r["kept_sha256"] for r in substring_dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert digest[-9] == hashlib.sha256(b"b").hexdigest()


def test_texts_of_megabytes(spark):
    r = random.Random(4)
    word = [f"w{i}x" for i in range(50_000)]
    long = " ".join(r.choice(word) for _ in range(300_000))
    rows = [(1, long), (2, long + " and the mit license at its end"), (3, "short " * 60), (4, "y" * 2_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cut = {x["doc_id"]: x for x in substring_dedup(df).collect()}
    assert cut[2]["n_removed"] == 300_000 and cut[2]["kept_text"] == "and the mit license at its end" and cut[1]["n_removed"] == 0
    byte = {x["doc_id"]: x for x in suffix_dedup(df).collect()}
    assert byte[1]["n_removed"] == len(long) and byte[4]["n_removed"] == 2_000_000 and byte[3]["n_removed"] == 0
    assert {x["doc_id"]: x["component_id"] for x in ngram_groups(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {x["doc_id"]: x["base_labels"] for x in license_scan(df).collect()} == {1: "", 2: "mit", 3: "", 4: ""}
    assert token_counts(df).filter("over_limit").count() == 3
    lab = spark.createDataFrame([(1, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    assert quality_scores(df, lab).filter("score BETWEEN 0 AND 1").count() == 4
    mixed = mixture(df.withColumn("source", F.lit("s")))
    assert mixed.filter("doc_id = 1").count() == 1


def test_scores_of_equal_rows_are_equal_and_labels_may_repeat(spark):
    rows = [(i, f"good words stand here {i}") for i in range(20)] + [(i, "### $$$ %% 11") for i in range(20, 40)] + [(3, "another text")] * 3
    lab = [(i, int(i < 20)) for i in range(40)] + [(1, 0), (None, 1), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = quality_scores(df, spark.createDataFrame(lab, "doc_id long, quality int")).collect()
    assert len(got) == len(rows) and len({r["score"] for r in got if r["doc_id"] == 3}) <= 2
