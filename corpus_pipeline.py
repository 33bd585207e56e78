"""The corpus pipeline: quality, near duplicates, repeated passages,
benchmark leaks, mixing. Each stage is (name, function of spark, docs,
sf_dir); ``docs`` is what the stage before kept, read back from Parquet. All
stages but the last return the columns of ``documents``.

Further columns, whatever their names, go through all stages (the last one
leaves out those called like what it adds). An empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import identity, stored, table, with_plain_names
from contrail.llm.decontaminate import without_leaks
from contrail.llm.mixing import mixture
from contrail.llm.ngram_join import set_groups
from contrail.llm.quality import scored, train
from contrail.llm.substring_dedup import substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents the classifier predicts to be good. Null and empty
    texts are scored as a text without words; repeated rows stay or go
    together; without labels all stay."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_plain_names(docs, lambda d: scored(d, model).filter("predicted = 1").select(*d.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents: the one with
    the smallest id, of rows with that id the one with the least text hash.
    Groups are of texts: rows that share an id, or have none, are linked by
    what they say only. Documents without words are in no group and stay. Of
    repeated rows of a kept document one stays."""
    def one_of_each(d: DataFrame) -> DataFrame:
        groups = set_groups(d)
        first = groups.filter("n > 0").groupBy("group").agg(F.min(F.struct("_id", "_th")).alias("r")).select("r._id", "r._th")
        keep = first.unionByName(groups.filter("n = 0").select("_id", "_th"))
        rows = d.select(*[d[c] for c in d.columns], *identity(d))
        return rows.join(keep, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"]).select(*d.columns)
    return with_plain_names(docs, one_of_each)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; a text nothing is left of
    goes. Texts that lose nothing, null and empty ones too, stay as they are,
    others are their kept words joined by spaces, with ``n_chars`` to match.
    Rows of one id, also exactly repeated ones, take nothing from each other."""
    def cut(d: DataFrame) -> DataFrame:
        out = substring_dedup(d)
        new = F.coalesce("kept_text", "text")
        cols = {"text": new.alias("text"), "n_chars": F.when(F.col("kept_text").isNull(), F.col("n_chars")).otherwise(
            F.length("kept_text")).cast(d.schema["n_chars"].dataType).alias("n_chars")}
        return out.filter("n_removed = 0 OR n_removed < n_words").select(*[cols.get(c, F.col(c)) for c in d.columns])
    return with_plain_names(docs, cut)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that repeat a benchmark item. Null and empty texts
    hold none; repeated rows stay or go together."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: one row per copy, with its output shard and place.
    Nulls, repeats and clashing columns as :func:`mixture` has them."""
    return mixture(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources", mixing),
]

ORACLE_SQL = None  # the classifier and the automata have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
