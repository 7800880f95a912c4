"""Fail-closed screening of texts with rule tables given as data.

A rule set names tag keywords, context patterns, forbidden and review patterns. The verdict is the
first of AGE, PROHIBITED, REVIEW that any rule gives, else PASS. A text without a verdict (null) is
never passed on: the gate keeps rows with verdict PASS only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from vellumix.functions.text import text_or_empty

_NUMBERS = "zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen"
#: Any age below 18 in digits or words, next to a word of age.
AGE = [rf"\b(?:[0-9]|1[0-7]|{_NUMBERS})[ -]?(?:years?|yrs?)[ -]?olds?\b", rf"\b(?:aged?|turned|turning)\s+(?:of\s+)?(?:[0-9]|1[0-7]|{_NUMBERS})\b(?!\s*(?:o'clock|minutes|hours|pages))", r"\b(?:underage|under-age|minors?|preteens?|pre-teens?)\b"]


@dataclass(frozen=True)
class RuleSet:
    """Tables of a screen. Patterns are matched without regard to case, in Java's syntax."""

    tag_keywords: tuple[str, ...] = ("underage", "minor", "preteen", "teen", "highschool", "juniorhigh")
    age: tuple[str, ...] = tuple(AGE)
    prohibited: tuple[str, ...] = (r"\bcontraband\b", r"\bforgery\b")
    review: tuple[str, ...] = (r"\bsmuggl\w*\b", r"\bthreaten\w*\s+(?:him|her|them|me)\b")
    negators: tuple[str, ...] = ("not", "never", "no", "without", "nobody")
    negation_chars: int = field(default=40)
    negation_words: int = field(default=3)

    def checked(self) -> RuleSet:
        """Itself, if no table is empty and all patterns compile."""
        for name in ("tag_keywords", "age", "prohibited", "review", "negators"):
            if not getattr(self, name):
                raise ValueError(f"empty rule table: {name}")
        for p in (*self.age, *self.prohibited, *self.review):
            re.compile(p)
        return self


DEFAULT = RuleSet()


def _any(patterns: tuple[str, ...]) -> str:
    return "(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def tag_hits(tags: Column, keywords: tuple[str, ...]) -> Column:
    """Keywords among the tags; hyphens and blanks inside a tag do not hide one."""
    have = F.flatten(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.array_union(F.regexp_extract_all(F.lower(t), F.lit("[a-z0-9]+"), F.lit(0)), F.array(F.regexp_replace(F.lower(t), "[^a-z0-9]", "")))))
    return F.array_intersect(have, F.array(*[F.lit(k) for k in keywords]))


def found_terms(c: Column, patterns: tuple[str, ...]) -> Column:
    """Distinct matches in lower case, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(_any(patterns)), F.lit(0)), F.lower)))


def unnegated_terms(rules: RuleSet):
    """A function of text: matches of the review rules that no negator precedes closely.

    The place of a match is needed, which no built-in function gives.
    """
    pattern = re.compile(_any(rules.review))
    negator = re.compile(r"\b(?:" + "|".join(map(re.escape, rules.negators)) + r")\b", re.IGNORECASE)

    @F.pandas_udf(ArrayType(StringType()))
    def terms(s: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str]:
            out = set()
            for m in pattern.finditer(text or ""):
                before = text[max(0, m.start() - rules.negation_chars) : m.start()]
                if not any(len(re.findall(r"\w+", before[n.end() :])) <= rules.negation_words for n in negator.finditer(before)):
                    out.add(m[0].lower())
            return sorted(out)

        return s.map(one)

    return terms


def with_verdict(df: DataFrame, text: str, tags: str | None = None, rules: RuleSet = DEFAULT, negation: bool = False) -> DataFrame:
    """``df`` with a struct ``safety``: verdict and sorted distinct terms."""
    rules.checked()
    t = text_or_empty(F.col(text))
    age = found_terms(t, rules.age)
    if tags:
        age = F.array_sort(F.array_union(age, tag_hits(F.col(tags), rules.tag_keywords)))
    prohibited = found_terms(t, rules.prohibited)
    review = unnegated_terms(rules)(t) if negation else found_terms(t, rules.review)
    step = df.withColumns({"_age": age, "_bad": prohibited, "_rev": review})
    verdict = F.when(F.size("_age") > 0, "AGE").when(F.size("_bad") > 0, "PROHIBITED").when(F.size("_rev") > 0, "REVIEW").otherwise("PASS")
    terms = F.array_sort(F.array_distinct(F.concat("_age", "_bad", "_rev")))
    return step.withColumn("safety", F.struct(verdict.alias("verdict"), terms.alias("terms"))).drop("_age", "_bad", "_rev")


def passed(catalog: DataFrame, tiers: list[str] | None = None) -> DataFrame:
    """Canonical rows with verdict PASS, of the given tiers; the only rows that consumers may read."""
    out = catalog.filter("is_canonical = 1 AND safety_verdict = 'PASS'")
    return out.filter(F.col("quality_tier").isin(tiers)) if tiers else out
