"""Scores, tiers, tags and narration data of a text, as columns over its metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import BARE_WORD, excerpt, let, text_or_empty

#: Lower bound of each tier.
TIERS = [(78.0, "Tier 1"), (62.0, "Tier 2"), (45.0, "Tier 3"), (None, "Tier 4")]
#: Words below the bound -> structure score.
LENGTH_SCORES = [(150, 2.0), (400, 8.0), (800, 15.0), (6001, 20.0), (15001, 18.0), (None, 14.0)]
#: Words below the bound -> duration class.
DURATIONS = [(1150, "micro"), (2350, "short"), (4550, "standard"), (9050, "feature"), (None, "long")]
#: Marked density below the bound -> level.
LEVELS = [(0.005, 1), (0.018, 2), (0.035, 3), (None, 4)]
I_WORDS, YOU_WORDS, THEY_WORDS = ("i", "me", "my", "mine", "we", "our"), ("you", "your", "yours"), ("he", "him", "his", "they", "them", "their")

#: Default rule tables, label -> words; neutral, and a parameter of every function that uses them.
THEMES = {"rivals": "rival|enemy|argued|hated", "friends": "friend|friends|neighbour", "journey": "train|ferry|harbour|voyage|wagon", "storm": "storm|rain|tide|snow", "letters": "letter|note|telegram|archive"}
ROLES = {"crafts": "carpenter|tailor|mechanic|gardener", "sea": "captain|pilot|sailor", "care": "doctor|nurse|midwife", "town": "mayor|landlord|clerk|editor"}
PLACES = {"house": "kitchen|cellar|attic|staircase", "water": "river|harbour|canal|ferry|jetty", "town": "market|hotel|tavern|theatre", "fields": "meadow|orchard|vineyard|pasture"}


def ladder(value: Column, steps: list) -> Column:
    """The result of the first step whose bound exceeds the value; the last step has none."""
    out = None
    for bound, result in steps:
        if bound is not None:
            out = F.when(value < bound, result) if out is None else out.when(value < bound, result)
    return out.otherwise(steps[-1][1])


def _clamped(c: Column, top: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(top), c))


def _points(*terms: Column) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _if(cond: Column, points: float) -> Column:
    return F.when(cond, points).otherwise(0.0)


def with_quality(df: DataFrame, text: str, metrics: str = "metrics") -> DataFrame:
    """``df`` with a struct ``quality``: five scores, total, tier and the penalties in order of evaluation."""
    t = text_or_empty(F.col(text))
    m = F.col(metrics)
    n, paras, avg, dialogue, sense, ttr = m.word_count, m.paragraph_count, m.avg_sentence_len, m.dialogue_ratio, m.sensory_density, m.ttr
    wall, few = (paras <= 1) & (n > 100), (paras < 3) & (n > 300)
    marks = t.rlike(r"<[^>]+>|https?://|[*~=]{3,}")
    no_upper, no_stop = ~t.rlike(r"\p{Lu}"), ~t.rlike("[.!?]")
    shouting = F.regexp_count(t, F.lit(r"\b[A-Z]{4,}\b")) > 5
    dense = (paras > 0) & (n > 250 * paras)
    odd = F.regexp_count(t, F.lit(r"[$#@&%_~^`|\\]")) > 3
    repeated = t.rlike(r"!{2,}|\?{2,}|\.{4,}")
    poor, long_ = (n >= 100) & (ttr < 0.25), avg > 35
    choppy = (avg < 7) & (n > 300)
    formatting = _clamped(20.0 + F.when(wall, -10.0).when(few, -5.0).otherwise(0.0) + _points(_if(marks, -6.0), _if(no_upper, -8.0), _if(no_stop, -6.0), _if(shouting, -4.0)), 20.0)
    structural = _clamped(ladder(n, LENGTH_SCORES) + _if(dense, -4.0), 20.0)
    variety = F.when(n < 100, 0.0).when(ttr >= 0.45, 6.0).when(ttr >= 0.35, 4.0).when(ttr < 0.25, -4.0).otherwise(0.0)
    senses = F.when(sense >= 0.025, 9.0).when(sense >= 0.015, 6.0).when(sense >= 0.008, 3.0).otherwise(0.0)
    prose = _clamped(F.when(n < 100, 4.0).otherwise(10.0) + variety + senses, 25.0)
    talk = F.when(dialogue.between(0.15, 0.45), 15.0).when((dialogue >= 0.08) & (dialogue < 0.15), 12.0).when((dialogue > 0.45) & (dialogue <= 0.65), 11.0).when(dialogue < 0.08, 7.0).otherwise(6.0)
    reading = _clamped(20.0 + F.when(long_, -8.0).when(avg > 25, -4.0).when(choppy, -4.0).otherwise(0.0) + _points(_if(no_stop, -8.0), _if(odd, -5.0), _if(repeated, -3.0)), 20.0)
    reasons = [(wall, "no_paragraphs"), (~wall & few, "few_paragraphs"), (marks, "markup_left"), (no_upper, "no_capitals"), (no_stop, "no_punctuation"), (shouting, "shouting"), (n < 150, "fragment"), ((n >= 150) & (n < 400), "very_short"), (dense, "dense_paragraphs"), (n < 100, "too_short_for_prose"), (poor, "repetitive"), (sense < 0.008, "few_sense_words"), (dialogue < 0.08, "little_dialogue"), (dialogue > 0.65, "mostly_dialogue"), (long_, "long_sentences"), (~long_ & (avg <= 25) & choppy, "choppy"), (no_stop, "no_sentence_ends"), (odd, "odd_symbols"), (repeated, "repeated_marks")]
    penalties = F.filter(F.array(*[F.when(c, F.lit(k)) for c, k in reasons]), lambda x: x.isNotNull())
    scores = {"formatting": formatting, "structural": structural, "prose": prose, "dialogue": talk, "readability": reading}
    out = df.withColumn("_s", F.struct(*[F.round(v, 1).alias(k) for k, v in scores.items()]))
    total = F.round(_points(*[F.col(f"_s.{k}") for k in scores]), 1)
    out = out.withColumn("_total", total)
    tier = F.when(F.col("_total") >= TIERS[0][0], TIERS[0][1]).when(F.col("_total") >= TIERS[1][0], TIERS[1][1]).when(F.col("_total") >= TIERS[2][0], TIERS[2][1]).otherwise(TIERS[3][1])
    return out.withColumn("quality", F.struct("_s.*", F.col("_total").alias("total"), tier.alias("tier"), penalties.alias("penalties"))).drop("_s", "_total")


def matching_labels(c: Column, rules: dict[str, str], default: str | None = None) -> Column:
    """Labels, in the order of the table, of which a word occurs in a lower-case text."""
    found = F.filter(F.array(*[F.when(c.rlike(rf"\b(?:{p})\b"), F.lit(k)) for k, p in rules.items()]), lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found) if default else found


def point_of_view(c: Column, first_chars: int = 3000) -> Column:
    """By pronouns in the first characters: second person if most frequent, first if more than 0.8 of third."""
    tokens = F.regexp_extract_all(F.substring(F.lower(c), 1, first_chars), F.lit(BARE_WORD), F.lit(0))
    share = lambda t, ws: F.size(F.filter(t, lambda w: w.isin(*ws)))
    counts = let(tokens, lambda t: F.struct(share(t, I_WORDS).alias("i"), share(t, YOU_WORDS).alias("you"), share(t, THEY_WORDS).alias("they")))
    return let(counts, lambda n: F.when((n.you > n.i) & (n.you > n.they), "Second Person").when(n.i > n.they * 0.8, "First Person").otherwise("Third Person"))


def pacing(dialogue: Column, sentence: Column) -> Column:
    return F.when((dialogue > 0.35) & (sentence < 16), "Fast").when((dialogue < 0.15) | (sentence > 24), "Slow").otherwise("Medium")


def with_tags(df: DataFrame, text: str, title: str | None = None, tags: str | None = None, metrics: str = "metrics", themes: dict | None = None, roles: dict | None = None, places: dict | None = None) -> DataFrame:
    """``df`` with a struct ``taxonomy`` from rule tables over title, tags and text."""
    parts = [text_or_empty(F.col(title)) if title else F.lit(""), F.array_join(F.coalesce(F.col(tags), F.array().cast("array<string>")), " ") if tags else F.lit(""), text_or_empty(F.col(text))]
    m = F.col(metrics)
    out = df.withColumn("_all", F.lower(F.concat_ws(" ", *parts)))
    themes_ = matching_labels(F.col("_all"), themes or THEMES, "other")
    struct = F.struct(
        themes_.alias("themes"),
        matching_labels(F.col("_all"), roles or ROLES).alias("roles"),
        matching_labels(F.col("_all"), places or PLACES).alias("places"),
        ladder(m.marked_density, LEVELS).alias("level"),
        point_of_view(text_or_empty(F.col(text))).alias("pov"),
        pacing(m.dialogue_ratio, m.avg_sentence_len).alias("pacing"),
        ladder(m.word_count, DURATIONS).alias("duration"),
    )
    return out.withColumn("taxonomy", struct).drop("_all")


#: Default voices: the first role found decides.
VOICES = [("sea", "deep"), ("crafts", "deep"), ("town", "crisp"), ("care", "warm")]


def narration(text: Column, metrics: Column, quality: Column, roles: Column, voices: list[tuple[str, str]] | None = None) -> Column:
    """Struct with duration, suitability, voice, pacing tag, segments and excerpt."""
    d, n = metrics.dialogue_ratio, metrics.word_count
    suit = F.greatest(F.lit(0.0), F.least(F.lit(100.0), quality.total * 0.95 + F.when(d.between(0.15, 0.40), 5.0).otherwise(0.0)))
    voice = F.lit("neutral")
    for role, name in reversed(voices or VOICES):
        voice = F.when(F.array_contains(roles, role), name).otherwise(voice)
    return F.struct(
        F.round(n / 150.0, 1).alias("minutes"),
        F.round(suit, 1).alias("suitability"),
        F.round(d * 100.0, 1).alias("dialogue_pct"),
        voice.alias("voice"),
        F.when(d > 0.35, "dynamic").when(d < 0.12, "narration").otherwise("balanced").alias("pacing_tag"),
        F.greatest(F.lit(1), F.ceil(n / 350).cast("int")).alias("segments"),
        excerpt(text).alias("excerpt"),
    )
