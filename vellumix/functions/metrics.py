"""Counts and ratios of a text, and a frame with all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import BARE_WORD, WS, has_ink, nonblank_parts, text_or_empty, words

QUOTED = r"[\"“][^\"”]+[\"”]"
SENTENCE_END = rf"[.!?]+(?:{WS}+|\z)"
#: Default lexicon of sense words; a parameter of every function that counts them.
SENSE_WORDS = ("warm", "cold", "rough", "smooth", "whispered", "murmured", "golden", "silver", "velvet", "dusty", "smoky", "salty", "amber", "shallow", "deep", "humid", "muddy", "pale", "dark", "loud")
#: Default pattern for the share of tokens that begin with one of its alternatives.
MARKED_WORDS = "love|kiss|touch|desire|passion"
WORDS_PER_MINUTE = 150


def quoted_words(c: Column) -> Column:
    """Number of words inside double quotes."""
    spans = F.regexp_extract_all(c, F.lit(QUOTED), F.lit(0))
    return F.aggregate(spans, F.lit(0), lambda n, s: n + F.size(F.regexp_extract_all(s, F.lit(BARE_WORD), F.lit(0))))


def ratio(a: Column, b: Column, digits: int) -> Column:
    return F.round(a / F.greatest(b, F.lit(1)), digits)


def lexicon_share(tokens: Column, lexicon: tuple[str, ...]) -> Column:
    """Share of tokens that belong to a word list."""
    return ratio(F.size(F.filter(tokens, lambda w: w.isin(*lexicon))), F.size(tokens), 4)


def pattern_share(tokens: Column, pattern: str) -> Column:
    """Share of tokens that match a pattern from their start as a whole word."""
    return ratio(F.size(F.filter(tokens, lambda w: w.rlike(rf"^(?:{pattern})\b"))), F.size(tokens), 4)


def with_metrics(df: DataFrame, text: str, scan_chars: int | None = None, lexicon: tuple[str, ...] = SENSE_WORDS, marked: str = MARKED_WORDS, parity: bool = True) -> DataFrame:
    """``df`` with a struct column ``metrics``.

    Densities are taken over the first ``scan_chars`` characters where given; then the dialogue ratio
    still divides by all words unless ``parity`` is off. Blank text has zeros everywhere.
    """
    t = text_or_empty(F.col(text))
    # every base value is a column of a stage of its own, so that no later expression repeats it
    step = df.withColumns({"_t": t, "_words": words(t)})
    scanned = F.substring("_t", 1, scan_chars) if scan_chars else F.col("_t")
    step = step.withColumns({
        "_scan": F.when(F.length("_t") <= scan_chars, F.col("_words")).otherwise(words(scanned)) if scan_chars else F.col("_words"),
        "_quoted": quoted_words(scanned),
        "_sentences": F.greatest(F.size(nonblank_parts(F.col("_t"), SENTENCE_END)), F.lit(1)),
        "_blank": ~has_ink(F.col("_t")),
    })
    n, sentences, scan_n = F.size("_words"), F.col("_sentences"), F.size("_scan")
    values = {
        "word_count": n,
        "char_count": F.length("_t"),
        "sentence_count": sentences,
        "paragraph_count": F.size(nonblank_parts(F.col("_t"), "\n\n")),
        "avg_sentence_len": F.round(n / sentences, 1),
        "dialogue_ratio": ratio(F.col("_quoted"), n if parity else scan_n, 3),
        "ttr": ratio(F.size(F.array_distinct("_scan")), scan_n, 3),
        "sensory_density": lexicon_share(F.col("_scan"), lexicon),
        "marked_density": pattern_share(F.col("_scan"), marked),
        "audio_min": F.round(n / float(WORDS_PER_MINUTE), 1),
    }
    kinds = {k: "int" if k.endswith("_count") else "double" for k in values}
    struct = F.struct(*[F.when(F.col("_blank"), F.lit(0)).otherwise(v).cast(kinds[k]).alias(k) for k, v in values.items()])
    return step.withColumn("metrics", struct).drop("_t", "_words", "_scan", "_quoted", "_sentences", "_blank")


def word_frequency(df: DataFrame, text: str, limit: int) -> DataFrame:
    """The most frequent words; equal counts are ordered by the word."""
    return df.select(F.explode_outer(words(text_or_empty(F.col(text)))).alias("word")).filter("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(limit)

