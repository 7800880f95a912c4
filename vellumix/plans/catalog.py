"""The chain from raw documents to catalogue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumix.functions.metrics import with_metrics
from vellumix.functions.scoring import narration, with_quality, with_tags
from vellumix.functions.text import clean_text, normalized_hash
from vellumix.operators.dedup import deduplicated
from vellumix.operators.screening import DEFAULT, RuleSet, with_verdict
from vellumix.storage import written

SCAN_CHARS = {"header": 3000, "density": 15_000, "preview": 8_000}
#: Words of a shingle by which near copies are decided.
SHINGLE_WORDS = 5


def cleaned(docs: DataFrame, entities: bool = True) -> DataFrame:
    """Documents (id, title, author, text, tags, ...) with ``clean`` in place of the raw text."""
    return docs.withColumn("clean", clean_text(F.col("text"), SCAN_CHARS["header"], entities)).drop("text")


def profiled(docs: DataFrame, rules: RuleSet = DEFAULT) -> DataFrame:
    """Cleaned documents with verdict, metrics, quality, taxonomy and narration.

    One narrow chain: no shuffle, every document on its own. ``docs`` should be a written table: an
    expression that many others use, as ``clean`` is, would else be computed again in each of them.
    """
    out = docs
    out = with_verdict(out, "clean", "tags", rules)
    out = with_metrics(out, "clean", SCAN_CHARS["density"])
    out = with_quality(out, "clean")
    out = with_tags(out, "clean", "title", "tags")
    return out.withColumn("tts", narration(F.col("clean"), F.col("metrics"), F.col("quality"), F.col("taxonomy.roles")))


def catalog_rows(profiled_docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat catalogue rows of profiled documents, before the duplicates are decided; ``keep`` names further columns."""
    m, q, t = "metrics", "quality", "taxonomy"
    return profiled_docs.select(
        "id", "title", "author", "source_archive", "created_date",
        *[f"{m}.{c}" for c in ("word_count", "char_count", "paragraph_count", "avg_sentence_len", "dialogue_ratio", "ttr", "sensory_density", "marked_density")],
        F.col("safety.verdict").alias("safety_verdict"), F.to_json("safety.terms").alias("safety_terms"),
        F.col(f"{q}.total").alias("quality_total"), F.col(f"{q}.tier").alias("quality_tier"), F.to_json(f"{q}.penalties").alias("quality_penalties"),
        F.to_json(f"{t}.themes").alias("tropes"), F.to_json(f"{t}.roles").alias("archetypes"), F.to_json(f"{t}.places").alias("settings"),
        F.col(f"{t}.level").alias("heat_level"), f"{t}.pov", f"{t}.pacing", F.col(f"{t}.duration").alias("duration_tier"),
        F.col("tts.minutes").alias("tts_minutes"), F.col("tts.suitability").alias("suitability"),
        normalized_hash(F.col("clean")).alias("exact_hash"), F.substring("clean", 1, SCAN_CHARS["preview"]).alias("preview"), *keep,
    )


def build(docs: DataFrame, least: float = 0.8, full_text: bool = False) -> DataFrame:
    """Catalogue rows with is_canonical and dup_of, which are decided on the whole clean texts; with ``full_text`` these stay, as ``clean``."""
    texts = written(cleaned(docs), "clean")
    choice = deduplicated(texts, "id", "clean", least, SHINGLE_WORDS).select("id", F.col("is_canonical").cast("int").alias("is_canonical"), "dup_of")
    return catalog_rows(profiled(texts), ("clean",) * full_text).join(choice, "id")


def audit(catalog: DataFrame) -> DataFrame:
    """One row of a batch's counters: by verdict and tier, canonical words and hours, first-tier rows."""
    canon = F.col("is_canonical") == 1
    return catalog.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(canon).alias("n_canonical"),
        *[F.count_if(canon & (F.col("safety_verdict") == v)).alias(f"n_{v.lower()}") for v in ("PASS", "REVIEW", "PROHIBITED", "AGE")],
        *[F.count_if(canon & F.col("quality_tier").startswith(f"Tier {k}")).alias(f"n_tier_{k}") for k in (1, 2, 3, 4)],
        F.sum(F.when(canon, F.col("word_count"))).cast("bigint").alias("canonical_words"),
        F.round(F.sum(F.when(canon, F.col("tts_minutes"))) / 60.0, 1).alias("canonical_hours"),
    )
