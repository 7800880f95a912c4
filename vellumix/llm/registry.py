"""Queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumix.storage import table, texts, written

from . import capping, confusables, knn, line_dedup, mixing, near_dup, oracle, packing, safety, splitting, text_stats


VECTOR_KEY = ["id", "chunk_index"]


def _p3_found(spark, sf_dir):
    pairs = knn.close_pairs(texts(spark, sf_dir, "chunk_vectors"), VECTOR_KEY)
    return pairs.selectExpr("a.id as id_a", "cast(a.chunk_index as int) as chunk_a", "b.id as id_b", "cast(b.chunk_index as int) as chunk_b")


def _p3_neighbours(spark, sf_dir):
    """Five nearest of every row whose id is divisible by 50, against all rows."""
    return knn.neighbours(texts(spark, sf_dir, "chunk_vectors"), VECTOR_KEY, queries="key.id % 50 = 0")


def reviewed(found: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(label, found, n): human judgements against what an operator found; a story judged twice counts twice."""
    known = labels.filter(F.col(column).isNotNull()).select(F.col("story_id").alias("id"), F.col(column).alias("label"))
    return known.join(found, "id").groupBy("label", "found").agg(F.count(F.lit(1)).alias("n"))


def _p5_by_story(spark, sf_dir):
    scored = safety.scored(texts(spark, sf_dir, "raw_stories"), table(spark, sf_dir, "screen_terms"), all_languages=False)
    return scored.groupBy(F.col("id").try_cast("bigint").alias("id")).agg(F.max("unsafe").alias("found")).filter("id IS NOT NULL")


def _p8_containers(spark, sf_dir):
    return packing.pack_documents(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_limits"))


def _p9_mixture(spark, sf_dir):
    return mixing.mixture(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def queries() -> dict:
    return {
        "p1_found": lambda s, d: text_stats.not_prose(texts(s, d, "stories")),
        "p1_statistics": lambda s, d: text_stats.compared(texts(s, d, "stories")),
        "p1_review": lambda s, d: reviewed(text_stats.text_statistics(texts(s, d, "stories")).select("id", (~F.col("is_prose")).alias("found")), table(s, d, "review_labels"), "is_non_prose"),
        "p2_found": lambda s, d: near_dup.similar_pairs(texts(s, d, "stories")),
        "p2_groups": lambda s, d: near_dup.groups(texts(s, d, "stories")),
        "p3_found": _p3_found,
        "p3_neighbours": _p3_neighbours,
        "p4_found": lambda s, d: capping.removed_rows(table(s, d, "stories")),
        "p4_contributors": lambda s, d: capping.contributor_report(table(s, d, "stories")),
        "p5_found": lambda s, d: safety.unsafe_ids(texts(s, d, "raw_stories"), table(s, d, "screen_terms")),
        "p5_scores": lambda s, d: safety.scored(texts(s, d, "raw_stories"), table(s, d, "screen_terms")),
        "p5_source_rates": lambda s, d: safety.rates(texts(s, d, "raw_stories"), table(s, d, "screen_terms")),
        "p5_review": lambda s, d: reviewed(_p5_by_story(s, d), table(s, d, "review_labels"), "is_unsafe"),
        "p6_found": lambda s, d: splitting.oversized(texts(s, d, "chunk_texts"), ["id", "chunk_index"]).selectExpr("id", "cast(chunk_index as int) as chunk_index"),
        "p6_pieces": lambda s, d: splitting.split_items(texts(s, d, "chunk_texts"), ["id", "chunk_index"]),
        "p7_found": lambda s, d: line_dedup.repeated_lines(texts(s, d, "raw_stories")).select("id", "line_no").distinct(),
        "p7_clean": lambda s, d: line_dedup.without_repeated_lines(texts(s, d, "raw_stories")),
        "p8_containers": _p8_containers,
        "p8_fill": lambda s, d: packing.report(_p8_containers(s, d)),
        "p9_mixture": _p9_mixture,
        "p9_shares": lambda s, d: mixing.shares(written(_p9_mixture(s, d), "mixture"), table(s, d, "mix_targets")),
        "p10_found": lambda s, d: confusables.lookalike_pairs(texts(s, d, "documents")).withColumnsRenamed({"id_a": "doc_id_a", "id_b": "doc_id_b"}),
        "p10_unified": lambda s, d: confusables.look_classes(texts(s, d, "documents")).withColumnRenamed("id", "doc_id"),
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
