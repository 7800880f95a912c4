"""Labels found in texts, and searches by combinations of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumix.functions.scoring import PLACES, ROLES, THEMES, matching_labels
from vellumix.functions.text import text_or_empty

from .screening import passed

#: Default tables of the extraction: type -> rule table.
TABLES = {"setting": PLACES, "character": ROLES, "dynamic": THEMES}


def mentions(df: DataFrame, id_col: str, text: str, tables: dict[str, dict[str, str]] | None = None, first_chars: int = 6000, topic: str | None = None) -> DataFrame:
    """(story_id, etype, label), one row for each label found; ``topic`` names a column that is a label itself."""
    low = F.lower(F.substring(text_or_empty(F.col(text)), 1, first_chars))
    typed = lambda etype, labels: F.transform(labels, lambda x: F.struct(F.lit(etype).alias("etype"), x.alias("label")))
    parts = [typed(etype, matching_labels(low, rules)) for etype, rules in (tables or TABLES).items()]
    if topic:
        parts.append(F.filter(F.array(F.struct(F.lit("topic").alias("etype"), F.initcap(F.replace(F.col(topic), F.lit("_"), F.lit(" "))).alias("label"))), lambda s: s.label.isNotNull()))
    return df.select(F.col(id_col).alias("story_id"), F.inline_outer(F.concat(*parts))).filter("etype IS NOT NULL")


def having_all(ids: DataFrame, key: str, found: DataFrame, wanted: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``ids`` that have every wanted (etype, label): one pass over the mentions, then a semi-join.

    Relational division: the distinct wanted labels of a story are counted; no label is too frequent
    for it, as the count is combined before the shuffle.
    """
    if not wanted:
        return ids
    pairs = list(dict.fromkeys(wanted))
    cond = None
    for e, label in pairs:
        one = (F.col("etype") == e) & (F.col("label") == label)
        cond = one if cond is None else cond | one
    full = found.filter(cond).groupBy("story_id").agg(F.count_distinct("etype", "label").alias("k")).filter(F.col("k") == len(pairs))
    return ids.join(full.select(F.col("story_id").alias(key)), key, "left_semi")


def facet_counts(catalog: DataFrame, found: DataFrame, etype: str, wanted: list[tuple[str, str]] | None = None, most: int = 40) -> DataFrame:
    """(label, n) of a type among passing stories that have all other wanted labels; ties by label."""
    ids = having_all(passed(catalog).select("id"), "id", found, wanted or [])
    hits = found.filter(F.col("etype") == etype).join(ids.withColumnRenamed("id", "story_id"), "story_id", "left_semi")
    return hits.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("label")).limit(most)


def search(catalog: DataFrame, found: DataFrame, wanted: list[tuple[str, str]], where: str | None = None, most: int = 50, offset: int = 0) -> DataFrame:
    """Passing stories with all wanted labels and a condition, best quality first; ties by id."""
    rows = having_all(passed(catalog), "id", found, wanted)
    rows = rows.filter(where) if where else rows
    cols = ["id", "title", "author", "category", "publication_date", "word_count", "quality_total", "quality_tier"]
    return rows.select(*cols).orderBy(F.desc_nulls_last("quality_total"), "id").offset(offset).limit(most)


def count(catalog: DataFrame, found: DataFrame, wanted: list[tuple[str, str]], where: str | None = None) -> DataFrame:
    rows = having_all(passed(catalog), "id", found, wanted)
    return (rows.filter(where) if where else rows).agg(F.count(F.lit(1)).alias("n"))


def hit_details(hits: DataFrame, catalog: DataFrame, bound: int = 10_000) -> DataFrame:
    """Catalogue rows of ranked hits (rank, id, score), in rank order; hits without a row are dropped. At most ``bound`` hits are broadcast."""
    small = hits.limit(bound + 1).count() <= bound
    return catalog.join(F.broadcast(hits) if small else hits, "id").orderBy("rank")


def with_full_text(catalog: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """Stories with their whole text, or the preview where none is stored."""
    return catalog.join(texts.select(key, "full_text"), key, "left").withColumn("text", F.coalesce("full_text", "preview", F.lit(""))).drop("full_text")
