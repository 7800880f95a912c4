"""Sinks: the catalogue, JSON lines, chunk files, and atomic publication of a directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_catalog(df: DataFrame, path: str, mode: str = "append", by: str | None = "quality_tier") -> None:
    """Append to the catalogue, one directory for each tier, so that a gated read prunes."""
    w = df.write.mode(mode).option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(path)


def write_texts(df: DataFrame, path: str, text: str = "full_text", most_chars: int = 400_000, least_words: int = 150) -> None:
    """Whole texts of the rows worth keeping: canonical, passing, of the upper tiers and not too short."""
    keep = "is_canonical = 1 AND safety_verdict = 'PASS' AND (quality_tier LIKE 'Tier 1%' OR quality_tier LIKE 'Tier 2%')"
    rows = df.filter(keep).filter(F.col("word_count") >= least_words).select("id", F.substring(text, 1, most_chars).alias("full_text"))
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunk files, the chunks of a document in order in one file; a full overwrite, so that none of an earlier run stays behind.

    Documents are dealt by a hash of the id into as many files as there are shuffle partitions; the id
    is a column of the rows, as a directory for each document would not scale.
    """
    ordered = chunks.repartition(F.col("id")).sortWithinPartitions("id", "chunk_id")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def ensure(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table at a path where there is none."""
    if not _fs(spark, path).exists(_path(spark, path)):
        spark.createDataFrame([], schema).write.parquet(path)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def publish(df: DataFrame, target: str) -> None:
    """Replace a directory at once: write beside it, move the old one away, move the new one in.

    A run that was interrupted between the moves is put right by ``recover``, which is called first.
    """
    spark = df.sparkSession
    recover(spark, target)
    fs, new, old = _fs(spark, target), _path(spark, target + ".new"), _path(spark, target + ".old")
    fs.delete(new, True)
    df.write.parquet(target + ".new")
    if fs.exists(_path(spark, target)):
        fs.rename(_path(spark, target), old)
    if not fs.rename(new, _path(spark, target)):
        fs.rename(old, _path(spark, target))
        raise OSError(f"could not publish {target}")
    fs.delete(old, True)


def recover(spark: SparkSession, target: str) -> bool:
    """Put the earlier directory back where a publication stopped half-way; whether it was needed."""
    fs, here, old = _fs(spark, target), _path(spark, target), _path(spark, target + ".old")
    if not fs.exists(old):
        return False
    if fs.exists(here):
        fs.delete(old, True)
        return False
    return bool(fs.rename(old, here))


def missing_settings(names: list[str]) -> list[str]:
    """Names of environment variables that are not set; never their values."""
    return [n for n in names if not os.environ.get(n)]
