"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from contrail.llm.ann import nearest_neighbours
from contrail.llm.common import table
from contrail.llm.conversations import repair_digest
from contrail.llm.decontaminate import contaminated
from contrail.llm.licenses import license_scan
from contrail.llm.lm_score import cross_entropy_difference
from contrail.llm.mixing import mix_sizes
from contrail.llm.ngram_join import ngram_groups
from contrail.llm.quality import quality_scores
from contrail.llm.runs import run_digest
from contrail.llm.shard_tree import shard_rows
from contrail.llm.substring_dedup import substring_dedup_digest
from contrail.llm.suffix_dedup import suffix_dedup
from contrail.llm.token_counts import token_counts


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup_digest(table(spark, sf_dir, "documents"))


def op2_lm_score(spark, sf_dir):
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_nearest_neighbours(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard_join(spark, sf_dir):
    return ngram_groups(table(spark, sf_dir, "documents"))


def op5_mixing(spark, sf_dir):
    return mix_sizes(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op7_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op11_sharding(spark, sf_dir):
    return shard_rows(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return run_digest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    return repair_digest(table(spark, sf_dir, "conversations"))


QUERIES = {q.__name__: q for q in (op1_substring_dedup, op2_lm_score, op3_nearest_neighbours, op4_ngram_jaccard_join, op5_mixing,
                                      op6_suffix_dedup, op7_quality, op8_token_counts, op9_decontamination,
                                      op10_license_scan, op11_sharding, op12_periodic_runs, op13_conversation_repair)}
ORACLE_SQL: dict[str, str] = {}
