"""Aggregates over a catalogue: summaries, distributions, trends, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumix.functions.text import json_strings

from .screening import passed

#: Upper bound and label of the length classes.
LENGTH_CLASSES = [(500, "<500"), (1000, "500-1K"), (2000, "1K-2K"), (4000, "2K-4K"), (8000, "4K-8K"), (16000, "8K-16K"), (None, "16K+")]
FIRST_YEAR, LAST_YEAR = 1970, 2026


def summary(catalog: DataFrame) -> DataFrame:
    """One row of totals over all rows, canonical rows and passing rows."""
    canon = F.col("is_canonical") == 1
    ok = canon & (F.col("safety_verdict") == "PASS")
    only = lambda c: F.when(ok, F.col(c))
    return catalog.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(canon).alias("canonical_rows"),
        F.count_if(~canon).alias("duplicate_rows"),
        F.round(100.0 * F.count_if(~canon) / F.greatest(F.count(F.lit(1)), F.lit(1)), 1).alias("duplicate_pct"),
        F.count_if(ok).alias("passing_rows"),
        F.sum(only("word_count")).cast("bigint").alias("passing_words"),
        F.round(F.sum(only("tts_minutes")) / 60.0, 1).alias("passing_hours"),
        F.round(F.avg(only("quality_total")), 1).alias("quality_avg"),
        F.min(only("quality_total")).alias("quality_min"),
        F.max(only("quality_total")).alias("quality_max"),
        F.min(F.when(ok & (F.col("publication_date") != ""), F.col("publication_date"))).alias("first_date"),
        F.max(F.when(ok & (F.col("publication_date") != ""), F.col("publication_date"))).alias("last_date"),
        F.count_distinct(only("author")).alias("authors"),
        F.count_distinct(F.when(canon, F.col("category"))).alias("categories"),
    )


def canonical_counts(catalog: DataFrame, dims: list[str]) -> DataFrame:
    """(dim, label, n) of canonical rows for each of several columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("label")) for d in dims])).alias("p")
    return catalog.filter("is_canonical = 1").select(pairs).groupBy("p.dim", "p.label").agg(F.count(F.lit(1)).alias("n"))


def _named(dim: str, labels: Column, struct) -> Column:
    return F.transform(labels, lambda x: struct(dim, x))


def distributions(catalog: DataFrame, arrays: list[str], scalars: list[str], most: int = 40) -> DataFrame:
    """(dim, label, n): the most frequent labels of every dimension; ties by label."""
    struct = lambda d, c: F.struct(F.lit(d).alias("dim"), c.cast("string").alias("label"))
    parts = [_named(d, json_strings(F.col(d)), struct) for d in arrays]
    parts.append(F.array(*[struct(d, F.col(d)) for d in scalars]))
    n = passed(catalog).select(F.explode(F.concat(*parts)).alias("p")).groupBy("p.dim", "p.label").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("n"), F.asc_nulls_last("label")))
    return n.withColumn("r", rank).filter(F.col("r") <= most).drop("r")


def top_authors(catalog: DataFrame, most: int = 25) -> DataFrame:
    """Authors by rows and words; blank ones are dropped after the limit, as they take a place."""
    top = passed(catalog).groupBy("author").agg(F.count(F.lit(1)).alias("n"), F.sum("word_count").cast("bigint").alias("words"))
    return top.orderBy(F.desc("n"), F.desc_nulls_last("words"), F.asc_nulls_last("author")).limit(most).filter("author <> ''").withColumn("words", F.coalesce("words", F.lit(0)))


def attribution(catalog: DataFrame, unknown: str = "Unknown / Anonymous") -> DataFrame:
    """Percentage of passing rows with a known author."""
    known = F.col("author").isNotNull() & (F.col("author") != unknown)
    return passed(catalog).agg(F.round(100.0 * F.count_if(known) / F.greatest(F.count(F.lit(1)), F.lit(1)), 1).alias("attribution_pct"))


def length_histogram(catalog: DataFrame) -> DataFrame:
    """(ord, label, n) with zero-filled classes; rows without a count belong to the last class."""
    spark = catalog.sparkSession
    names = [(i, label) for i, (_, label) in enumerate(LENGTH_CLASSES)]
    out = None
    for bound, label in LENGTH_CLASSES[:-1]:
        cond = F.col("word_count") < bound
        out = F.when(cond, label) if out is None else out.when(cond, label)
    counts = passed(catalog).groupBy(out.otherwise(LENGTH_CLASSES[-1][1]).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame(names, "ord int, label string").join(counts, "label", "left").select("ord", "label", F.coalesce("n", F.lit(0)).alias("n"))


def yearly(catalog: DataFrame) -> DataFrame:
    """Rows and averages by year, in one aggregation."""
    year = F.substring("publication_date", 1, 4)
    rows = passed(catalog).withColumn("year", year).filter(F.col("year").rlike("^[0-9]{4}$"))
    rows = rows.filter(F.col("year").cast("int").between(FIRST_YEAR, LAST_YEAR))
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("word_count")).alias("avg_words"), F.round(F.avg("heat_level"), 2).alias("avg_level"), F.round(F.avg("quality_total"), 1).alias("avg_quality"))


def _decade():
    return F.concat(F.substring("publication_date", 1, 3), F.lit("0s"))


def label_share_by_decade(catalog: DataFrame, labels: str = "tropes", top: int = 8) -> DataFrame:
    """(decade, label, pct): share of each of the overall top labels among their mentions of a decade, zero-filled."""
    one = passed(catalog).select("publication_date", F.explode(json_strings(F.col(labels))).alias("label"))
    best = one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(top).select("label")
    seen = one.filter(F.length("publication_date") >= 4).select(_decade().alias("decade"), "label").join(F.broadcast(best), "label", "left_semi").groupBy("decade", "label").agg(F.count(F.lit(1)).alias("n"))
    # zero-fill: each decade times the top labels, at most ``top`` rows a decade
    all_labels = best.agg(F.array_sort(F.collect_list("label")).alias("ls")).first().ls
    grid = seen.select("decade").distinct().select("decade", F.explode(F.array(*[F.lit(x) for x in all_labels]) if all_labels else F.array().cast("array<string>")).alias("label"))
    full = grid.join(seen, ["decade", "label"], "left").select("decade", "label", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("decade"))
    return full.select("decade", "label", F.round(100.0 * F.col("n") / F.greatest(total, F.lit(1)), 1).alias("pct"))


def top_by_decade(catalog: DataFrame, column: str = "category", most: int = 10) -> DataFrame:
    n = passed(catalog).filter(F.length("publication_date") >= 4).groupBy(_decade().alias("decade"), F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("decade").orderBy(F.desc("n"), F.asc_nulls_last("label")))
    return n.withColumn("rank", rank).filter(F.col("rank") <= most)


def quality_by(catalog: DataFrame, dims: list[str], most: int = 15) -> DataFrame:
    """(dim, label, n, averages) of the most frequent labels of each dimension, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("label")) for d in dims])).alias("p")
    g = passed(catalog).select(pairs, "quality_total", "heat_level", "word_count").groupBy("p.dim", "p.label")
    agg = g.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality_total"), 1).alias("avg_quality"), F.round(F.avg("heat_level"), 2).alias("avg_level"), F.round(F.avg("word_count")).alias("avg_words"))
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("n"), F.asc_nulls_last("label")))
    return agg.withColumn("r", rank).filter(F.col("r") <= most).drop("r")


def ranked_candidates(catalog: DataFrame, tiers: list[str], least: float = 75.0, most: int = 50_000, by: tuple[str, ...] = ("quality_total", "suitability"), id_col: str = "id") -> DataFrame:
    """Passing rows of the tiers from a score on, best first; ties by id."""
    rows = passed(catalog, tiers).filter(F.col("quality_total") >= least)
    return rows.orderBy(*[F.desc(c) for c in by], id_col).limit(most)


def capped_signatures(errors: DataFrame, signature: str, most: int = 100) -> DataFrame:
    """(signature, n) of the most frequent causes, the others summed as ``other``."""
    n = errors.groupBy(F.col(signature).alias("signature")).agg(F.count(F.lit(1)).alias("n"))
    top = n.orderBy(F.desc("n"), "signature").limit(most)
    rest = n.join(top.select("signature"), "signature", "left_anti").agg(F.sum("n").alias("n")).filter("n IS NOT NULL").select(F.lit("other").alias("signature"), "n")
    return top.unionByName(rest)


def verdict_measure(df: DataFrame, verdict: str, words: str) -> DataFrame:
    """(verdict, n, pct, upper median of the words) of each verdict.

    The median is the element at half the count of the sorted values, picked by rank, so that no
    verdict's values are gathered in a list.
    """
    rows = df.select(F.col(verdict).alias("verdict"), F.col(words).alias("w")).filter("w IS NOT NULL")
    hist = rows.groupBy("verdict", "w").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("verdict").orderBy("w")
    ranked = hist.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("verdict")))
    median = ranked.filter(F.col("upto") > F.floor(F.col("n") / 2)).groupBy("verdict").agg(F.min("w").alias("median_words"))
    totals = df.groupBy(F.col(verdict).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
    all_rows = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return totals.join(median, "verdict", "left").select("verdict", "n", F.round(100.0 * F.col("n") / all_rows, 1).alias("pct"), "median_words")
