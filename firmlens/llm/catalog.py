"""The package's queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (best_position, dart_minhash, licenses, line_runs, mixing, outliers, part_enum,
               permutation_index, pieces, quality_rank, sentence_spans, spelling, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    return toxicity.toxic_documents(_table(spark, sf_dir, "documents"),
                                    _table(spark, sf_dir, "labels"))


def op2_mixing(spark, sf_dir):
    return mixing.mixed_documents(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    return line_runs.line_digest(_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark, sf_dir):
    return dart_minhash.near_documents(_table(spark, sf_dir, "documents"))


def op5_pieces(spark, sf_dir):
    return pieces.encoded_documents(_table(spark, sf_dir, "documents"))


def op6_licenses(spark, sf_dir):
    return licenses.license_documents(_table(spark, sf_dir, "documents"))


def op7_sentence_spans(spark, sf_dir):
    return sentence_spans.span_documents(_table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality_rank.quality_documents(_table(spark, sf_dir, "documents"),
                                          _table(spark, sf_dir, "labels"))


def op9_outliers(spark, sf_dir):
    return outliers.judged(_table(spark, sf_dir, "documents"))


def op10_nearest(spark, sf_dir):
    return permutation_index.search(_table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark, sf_dir):
    return best_position.search(_table(spark, sf_dir, "documents"),
                                _table(spark, sf_dir, "benchmark"))


def op12_jaccard_join(spark, sf_dir):
    return part_enum.linked_documents(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_forms(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_mixing": (op2_mixing, mixing.MIX_SQL),
    "op3_line_dedup": (op3_line_dedup, line_runs.LINE_SQL),
    "op4_near_duplicates": (op4_near_duplicates, None),
    "op5_pieces": (op5_pieces, None),
    "op6_licenses": (op6_licenses, licenses.license_sql()),
    "op7_sentence_spans": (op7_sentence_spans, None),
    "op8_quality": (op8_quality, None),
    "op9_outliers": (op9_outliers, None),
    "op10_nearest": (op10_nearest, None),
    "op11_ranked_search": (op11_ranked_search, best_position.SEARCH_SQL),
    "op12_jaccard_join": (op12_jaccard_join, part_enum.LINK_SQL),
    "op13_spelling_variants": (op13_spelling_variants, spelling.SPELLING_SQL),
}
