"""Operators 2, 3, 5, 7, 8, 9, 10 and the pipeline on small fixtures with
nulls, empty texts, repeated rows, odd columns and empty tables."""
import math
import re
import zlib

import numpy as np
import pytest

from contrail.llm.ann import hilbert_keys, nearest_neighbours
from contrail.llm.decontaminate import contaminated, without_leaks
from contrail.llm.licenses import Automaton, license_scan
from contrail.llm.lm_score import cross_entropy_difference
from contrail.llm.mixing import mix_sizes, mixture, split, targets
from contrail.llm.quality import quality_scores
from contrail.llm.token_counts import default_path, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(1, "a b c", "en", "s1", 5), (2, None, "en", "s2", 0), (3, "", None, "s2", 0), (None, "x  y", "en", None, 4),
        (4, "d e", "fr", "s1", 3), (4, "d e", "fr", "s1", 3), (5, "w " * 3000, "en", "s3", 6000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")


def test_token_counts_equal_the_library(spark, odd):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_path())
    texts = ["it's <|endoftext|> 12é\n\n  x", "<|endoftext|>", " \x1c z", *[r[1] for r in ROWS]]
    df = spark.createDataFrame([(i, x, "k") for i, x in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts(df).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert got[i] == (len((x or "").encode()), n, n > 1024)
    assert token_counts(odd.limit(0)).count() == 0


def test_licenses_equal_brute_force(spark, odd):
    texts = ["Released under the MIT License.", "mit license MIT-license apache license", "GNU General Public License v3",
             "this work is licensed under the GNU General Public License, version 3.", "mit", None, "x mit", "license y"]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(texts)], "doc_id long, text string, labels int")
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    base = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for r in license_scan(df.coalesce(1)).collect():
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]] or ""))
        at = sorted((i, b) for p, b in base.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({b for _, b in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    got = {r["doc_id"]: r["labels"] for r in license_scan(df).collect()}
    assert got[0] == "mit,mit-notice" and got[3] == "gpl,gpl-notice" and got[2] == "gpl"
    assert license_scan(odd.limit(0)).count() == 0 and license_scan(odd).count() == len(ROWS)


def test_template_automaton():
    m = Automaton()
    m.add("t", "a <<opt b c>> <<x|y z>> <<var 2>> end")
    assert m.accept("a x 1 end".split(), 0) == [("t", 4)]
    assert m.accept("a b c y z 1 2 end".split(), 0) == [("t", 8)]
    assert m.accept("a b x 1 end".split(), 0) == [] and m.accept("a x 1 2 3 end".split(), 0) == []


def test_decontamination(spark, odd):
    item = "How long does Maria need to fill 12 buckets of 5 litres when each pump gives 3 litres a minute"
    other = item.replace("Maria", "Jonas").replace("12", "40").replace("5", "9")
    mixed = item.replace("5 litres", "7 litres").replace("3 litres", "8 litres")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "a b"), (10, "the capital of France is Paris not Lyon")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "pre text. " + item + ". post", 1), (2, other, 1), (3, mixed, 1),
                                  (4, "nothing of the kind stands here at all today my friends", 1), (5, None, 1), (6, "", 1),
                                  (1, "pre text. " + item + ". post", 1)], "doc_id long, text string, h int")
    got = {r["doc_id"]: r["item_ids"] for r in contaminated(docs, bench).collect()}
    assert got == {1: [7], 2: [7], 3: [7]}
    assert sorted(r["doc_id"] for r in without_leaks(docs, bench).collect()) == [4, 5, 6]
    assert contaminated(odd.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0
    # one value of the item may not become two
    twice = spark.createDataFrame([(1, "take 5 apples and then give back 5 pears to the old man here")], "item_id long, text string")
    d = spark.createDataFrame([(1, "take 6 apples and then give back 9 pears to the old man here")], "doc_id long, text string")
    assert contaminated(d, twice, window=12).count() == 0


def test_targets_and_splits():
    assert targets([100, 100, 100], [1, 2, 3]) == [50.0, 100.0, 150.0]
    assert targets([10, 290, 0], [3, 1, 2]) == [30.0, 270.0, 0.0]
    assert targets([], []) == [] and targets([0, 0], [1, 2]) == [0.0, 0.0]
    q = np.array([7, 0, 13, 5])
    tree = split(q, 5, np.random.default_rng(1))
    assert tree.shape == (5, 4) and (tree.sum(0) == q).all() and (tree >= 0).all() and tree.sum(1).tolist() == [5] * 5


def test_mixing(spark, odd):
    rows = sorted(map(tuple, mix_sizes(odd, blocks=8).collect()), key=str)
    assert rows == sorted(map(tuple, mix_sizes(odd.repartition(5), blocks=8).collect()), key=str)
    assert len(rows) == len(ROWS) and sum(r[1] for r in rows) == 3 + 2 + 2 + 2 + 3000
    assert all(r[4] <= 3 * r[1] for r in rows)
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "en", f"s{i % 4}", 1) for i in range(400)], SCHEMA)
    out = mix_sizes(df, blocks=16).toPandas()
    src = out["doc_id"] % 4
    for s in range(4):
        part = out[src == s]
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 1 and part["size"].sum() == part["source_size"].iloc[0]
    assert mix_sizes(df.limit(0)).count() == 0
    mixed = mixture(df, blocks=16).toPandas()
    assert mixed["words"].sum() == out["taken"].sum()
    assert (mixed["text"].str.split().str.len() == mixed["words"]).all()


def test_quality(spark, odd, labels):
    r = np.random.default_rng(3)
    rows = [(i, " ".join("".join(r.choice(list("abcdefgh"), 5)) + ("%%%" if i % 3 == 0 else "") for _ in range(90)))
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(600)], "doc_id long, quality int")
    out = quality_scores(docs, lab).toPandas()
    held = out[out["held_out"]]
    assert all(out["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"]])
    assert (held["predicted"] == (held["doc_id"] % 3 != 0)).mean() > 0.95 and out["score"].between(0, 1).all()
    assert quality_scores(odd, labels).count() == len(ROWS)
    assert quality_scores(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 1.0
    assert quality_scores(odd.limit(0), labels).count() == 0


def test_lm_scores_equal_brute_force(spark, odd, labels):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "a c c"), (3, None), (4, "z a b")], "doc_id long, text string")
    lab = spark.createDataFrame([(2, 1), (4, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in cross_entropy_difference(docs, lab).collect()}

    def loss(text, corpus):
        w, vocab = text.split(), ["a", "b", "c", "z"]
        uni = {x: sum(t.split().count(x) for t in corpus) for x in vocab}
        bi = [p for t in corpus for p in zip(t.split(), t.split()[1:])]
        total, size = sum(uni.values()), 5
        out = 0
        for i, x in enumerate(w):
            p = (uni[x] + .5) / (total + .5 * size)
            out -= math.log(p if i == 0 else .3 * p + .7 * bi.count((w[i - 1], x)) / max(uni[w[i - 1]], 1))
        return out / len(w)
    texts = ["a b a c", "a c c", "z a b"]
    for i, t in ((1, texts[0]), (2, texts[1]), (4, texts[2])):
        assert got[i]["background_loss"] == pytest.approx(loss(t, texts), abs=2e-6)
        assert got[i]["target_loss"] == pytest.approx(loss(t, [texts[1]]), abs=2e-6)
    assert (got[3]["n_tokens"], got[3]["score"]) == (0, 0.0)
    assert cross_entropy_difference(odd, labels).count() == len(ROWS)
    assert cross_entropy_difference(odd.limit(0), labels).count() == 0


def test_hilbert_curve_is_a_walk():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_neighbours(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(600, 16)).astype(np.float32)
    x[100:160] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(700, None, 0), (800, [0.0] * 16, 0), (900, [float("nan")] * 16, 0), (None, x[3].tolist(), 0),
             (1000, [None] + [1.0] * 15, 0), (1100, [1.0], 0), rows[5], (1200, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = nearest_neighbours(df).toPandas()
    x64, hit, all_ = x.astype(np.float64), 0, 0
    for q in range(0, 600, 100):
        dist = np.sqrt(((x64 - x64[q]) ** 2).sum(1))
        dist[q] = np.inf
        want = np.lexsort((np.arange(600), dist))[:10]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["score"].is_monotonic_increasing and len(mine) == 10
        assert np.allclose(mine["score"], dist[mine["vec_id"]])
        hit, all_ = hit + len(set(want) & set(mine["vec_id"])), all_ + 10
    assert hit / all_ >= 0.9
    assert got[got["query_id"] == 0]["vec_id"].tolist() == list(range(100, 110))
    assert set(got["query_id"]) == set(range(0, 600, 100))
    assert nearest_neighbours(df.limit(0)).count() == 0
    assert nearest_neighbours(df.filter("vec_id in (100, 101)")).count() == 1


def test_pipeline_on_a_small_corpus(spark):
    import corpus_pipeline as P
    out = P.run(spark, "/root/testdata/sf0.001").toPandas()
    assert len(P.STAGES) == 5 and {"doc_id", "text", "lang", "source", "n_chars", "copy", "shard"} <= set(out.columns)
    assert len(out) and (out["text"].str.split().str.len() == out["words"]).all()


def test_lm_scores_do_not_depend_on_the_broadcast_tier(spark):
    r = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{x}" for x in r.zipf(1.3, 60) % 500)) for i in range(80)] + [(3, "w1 w2"), (3, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)], "doc_id long, quality int")
    got = [sorted(map(tuple, cross_entropy_difference(docs, lab, vocabulary=v, bigrams=b).collect()))
           for v, b in ((10**6, 10**6), (40, 60), (0, 0))]
    assert len(got[0]) == len(rows)
    for other in got[1:]:
        assert [x[:2] for x in other] == [x[:2] for x in got[0]]
        assert np.allclose([x[2:] for x in other], [x[2:] for x in got[0]], atol=3e-6)
    # words of one count each, more than the tier holds: all are still told apart
    even = spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    score = {x["doc_id"]: x["score"] for x in cross_entropy_difference(even, lab, vocabulary=3, bigrams=3).collect()}
    assert score[1] < 0 < score[2]


def test_decontamination_finds_copies_in_other_case(spark):
    item = "Where did Élodie Marchand of Lyon hide the letter. She gave Paul Durand and Anne Petit one key each"
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "before it " + item.upper() + " AFTER IT"), (2, item.lower()), (3, item.replace(".", "")), (4, item.title()),
        (5, item.replace("Élodie", "Ángela")), (6, "Where did the letter of the town go that nobody gave to anyone at all"),
    ], "doc_id long, text string")
    got = {r["doc_id"]: r["share"] for r in contaminated(docs, bench).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[1] == got[2] == got[3] == 1.0


def test_decontamination_finds_short_and_all_slot_items(spark):
    sums = "12 + 7 = 19, 8 + 5 = 13, 20 - 4 = 16, 9 + 9 = 18"
    names = "ask Anna Berg, Carl Dahl, Eva Falk, Gustav Holm, Ida Jansson, Karl Lind and Maja Norberg"
    bench = spark.createDataFrame([(1, "name the tallest bird"), (2, sums), (3, names), (4, "Who wrote Faust")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "in the quiz they had to name the tallest bird of all and nobody knew which one"),
        (2, "the sheet says " + sums + " and no more than that was written on it"),
        (3, "to learn more " + names + " who were all there on that day"),
        (4, "the teacher said: who wrote Faust, and the class had no answer to that question"),
        (5, "12 + 7 = 20, 8 + 5 = 14, 20 - 4 = 17, 9 + 9 = 19 is another sheet and the tallest bird"),
        (6, "name the tallest bird"), (7, "name the tallest")], "doc_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in contaminated(docs, bench).collect()}
    assert got == {1: [1], 2: [2], 3: [3], 4: [4], 6: [1]}


MIT = """Copyright (c) 2020 Jo Doe

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_whole_license_texts_are_accepted_and_altered_ones_refused(spark):
    upto = MIT.index("without restriction") + len("without restriction")
    texts = {
        1: "x " * 30 + MIT + " int main() {}", 2: MIT.replace("THE AUTHORS OR\nCOPYRIGHT HOLDERS", "ACME SOFTWARE LTD"),
        3: MIT[:upto] + " but only for non commercial purposes" + MIT[upto:], 4: MIT[:upto] + ".",
        5: MIT.replace("sublicense, ", ""), 6: MIT.replace('(the "Software"), ', ""), 7: MIT + "\n" + MIT}
    got = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {k for k, r in got.items() if "mit-text" in r["labels"].split(",")} == {1, 2, 6, 7}
    assert got[3]["score"] == got[4]["score"] == got[5]["score"] == 0.0 and got[7]["spans"].count("mit-text") == 2


def test_near_duplicates_keeps_different_texts_of_null_and_repeated_ids(spark):
    from corpus_pipeline import near_duplicates
    said = ["the harbour was quiet when the last ferry left for the islands that night",
            "bread needs flour water salt and more patience than most people want to give",
            "old maps of the valley show a river where the road to the mill runs now",
            "she counted nine herons on the bank and wrote the number in a small green book"]
    near = "zero " + " ".join(f"w{i}" for i in range(60))
    rows = [(None, said[0]), (None, said[1]), (5, said[2]), (5, said[3]), (5, said[3]), (7, near), (8, near + " end"),
            (None, near), (9, None), (9, "  "), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in near_duplicates(spark, docs, "").collect()), key=str)
    want = [(None, said[0]), (None, said[1]), (5, said[2]), (5, said[3]), (7, near), (9, None), (9, "  "), (None, "")]
    assert got == sorted(want, key=str)


def test_neighbour_queries_are_dealt_in_bounded_chunks(spark):
    from contrail.llm.ann import dealt
    r = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r.normal(size=(400, 8)))],
                               "vec_id long, embedding array<float>")
    spots = df.selectExpr("vec_id AS point", "0 AS curve", "vec_id AS place", "embedding AS v")
    got = dealt(spots, df.selectExpr("vec_id AS point"), 400, 400, chunk=50)
    groups = got.filter("ask").groupBy("curve", "block", "chunk").count().toPandas()
    assert groups["count"].sum() == 400 and groups["count"].max() <= 100
    assert set(got.filter("NOT ask").groupBy("chunk").count().toPandas()["count"]) == {400}
    one, many = (sorted(map(tuple, nearest_neighbours(df, every=4, chunk=c).collect())) for c in (1000, 10))
    assert one == many and len(one) == 1000
