"""Problem 10: bring text that looks the same to one consistent form.

Method: script-aware repair. Width and joined forms, composition, invisible characters and kinds of
blank are folded first. Then the dominant script of each token is determined, by its letters without
a look-alike; in a mixed-script token the letters of the other scripts are replaced by look-alikes of
the dominant one, and the replacement is kept only if the result occurs in the corpus vocabulary. A
token that consists of look-alikes only has no dominant script of its own and takes that of its text.
A word counts as part of the vocabulary if a text holds it in that form, or if two different
spellings in the corpus are repaired to it; so two altered copies of a word meet although the
unaltered one occurs nowhere. Equal appearance is equality of the repaired texts.

Scale: texts are folded in one pass, which also hashes those without a doubtful token; the vocabulary
is a pre-aggregated distinct joined with the few distinct repairs, and only documents that hold a
doubtful token are touched again. Documents are grouped by a 128-bit hash of the repaired text: texts
are not shuffled, but for those with a doubtful token.

Defined cases: null texts stay null and form no pair; empty or blank texts stay as they are; texts
without a letter or digit form no pair; repeated rows of a document count once; joiners and
presentation selectors inside an emoji are kept, since without them it looks different. Other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumix.storage import written

from .common import code_points, map_arrow

#: Letters of Cyrillic and Greek (and a few Latin ones) and the plain Latin letter of the same shape.
SHAPES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХҮԌԚԜаеѕіјкорсухһԁԛԝӏ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "ανορυικϲ" + "ɡıɑ",
        "ABESIJKMHOPCTYXYGQWaesijkopcyxhdqwl" + "ABEZHIKMNOPTYX" + "avopuikc" + "gia",
        strict=True,
    )
)
AMBIGUOUS = set(SHAPES) | set(SHAPES.values())
#: A letter, and letters with their combining marks.
TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f])*")
INK = re.compile(r"[^\W_]")
EMOJI = (0x1F000, 0x1FAFF), (0x2600, 0x27BF), (0x2190, 0x21FF), (0x2B00, 0x2BFF)


@functools.cache
def fold_table() -> dict[int, str]:
    """Characters to fold, by rule from the Unicode database: width, joined and positional forms, blanks, unmarked characters."""
    table: dict[int, str] = {0x2028: "\n", 0x2029: "\n", 0x85: "\n", 0x09: " ", 0x115F: "", 0x1160: "", 0x3164: " ", 0x34F: "", 0x180E: "", 0x2800: " "}
    for cp in [*range(0xA0, 0x10000), *range(0xE0000, 0xE0200)]:
        c = chr(cp)
        kind, how = unicodedata.category(c), unicodedata.decomposition(c)
        tag = how.split(">")[0].lstrip("<") if how.startswith("<") else ""
        if kind == "Zs":
            table[cp] = " "
        elif kind == "Cf" or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF:
            table[cp] = ""
        elif tag in ("wide", "narrow", "initial", "medial", "final", "isolated"):
            table[cp] = unicodedata.normalize("NFKC", c)
        elif tag == "compat" and kind[0] == "L" and len(how.split()) > 2 and all(unicodedata.category(x)[0] == "L" for x in unicodedata.normalize("NFKC", c)):
            table[cp] = unicodedata.normalize("NFKC", c)
    return table


def _emoji(c: str) -> bool:
    return any(a <= ord(c) <= b for a, b in EMOJI)


KEEPER = re.compile("[\ufe0f\u200d]")


@functools.cache
def _foldable() -> re.Pattern:
    # the tags and selectors beyond the basic plane as a range: single characters there are looked up one by one
    return re.compile("[" + re.escape("".join(chr(c) for c in fold_table() if c < 0x10000)) + "\U000e0000-\U000e01ff]")


def fold(text: str) -> str:
    """Text with one width, one composition, one blank and nothing invisible."""
    text = text.replace("\r\n", "\n")
    if text.isascii():
        return text.replace("\t", " ")
    if _foldable().search(text):
        table = fold_table()
        if KEEPER.search(text) and any(_emoji(c) for c in text):
            out = []
            for i, c in enumerate(text):
                before = text[i - 1] if i else ""
                if c == "\ufe0f" and before and _emoji(before):
                    out.append(c)
                elif c == "\u200d" and before and (_emoji(before) or before == "\ufe0f") and i + 1 < len(text) and _emoji(text[i + 1]):
                    out.append(c)
                else:
                    out.append(table.get(ord(c), c))
            text = "".join(out)
        else:
            text = _foldable().sub(lambda m: table.get(ord(m[0]), m[0]), text)
    return unicodedata.normalize("NFC", text)


def script(c: str) -> str:
    """Latin, Cyrillic, Greek or other."""
    cp = ord(c)
    if cp < 0x250 or 0x250 <= cp <= 0x2AF or 0x1E00 <= cp <= 0x1EFF:
        return "Latin"
    if 0x370 <= cp <= 0x3FF or 0x1F00 <= cp <= 0x1FFF:
        return "Greek"
    return "Cyrillic" if 0x400 <= cp <= 0x52F else "other"


@functools.cache
def _towards(best: str) -> dict[int, str]:
    """Letters of the other scripts that have a look-alike in ``best``."""
    if best == "Latin":
        return {ord(a): b for a, b in SHAPES.items()}
    own: dict[str, str] = {}
    for letter, latin in SHAPES.items():
        if script(letter) == best:
            own.setdefault(latin, letter)
    from_latin = {ord(latin): letter for latin, letter in own.items()}
    return from_latin | {ord(a): own.get(b, b) for a, b in SHAPES.items() if script(a) != best}


SCRIPTS = ("Latin", "Cyrillic", "Greek")
#: Letters that can make a token of a Latin text doubtful.
FOREIGN = re.compile("[\u0370-\u03ff\u1f00-\u1fff\u0400-\u052f" + "".join(c for c in SHAPES if script(c) == "Latin") + "]")


@functools.cache
def _firm_table() -> np.ndarray:
    """For each code point of the basic plane 1, 2 or 3: a Latin, Cyrillic or Greek letter that has no look-alike; else 0."""
    table = np.zeros(0x10000, np.uint8)
    for cp in [*range(0x41, 0x530), *range(0x1E00, 0x2000)]:
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if chr(cp).isalpha() and base not in AMBIGUOUS and script(base) != "other":
            table[cp] = 1 + SCRIPTS.index(script(base))
    return table


def dominant(text: str) -> str | None:
    """The script of most letters that have no look-alike; ties go to Latin, Cyrillic, Greek in this order; None without any."""
    cp = code_points(text)
    own = np.bincount(_firm_table()[cp[cp < 0x10000]], minlength=4)[1:]
    return SCRIPTS[int(np.argmax(own))] if own.any() else None


@functools.lru_cache(maxsize=200_000)
def repaired(token: str, around: str) -> str:
    """A token in one script: that of its letters without look-alikes, else that of its text.

    Letters of that script stay; of the others each look-alike is replaced, by the Latin letter of its
    shape where the script itself has none. Tokens that look the same come out the same.
    """
    out = unicodedata.normalize("NFD", token).translate(_towards(dominant(token) or around))
    return unicodedata.normalize("NFC", out)


def doubtful_tokens(text: str) -> list[tuple[str, str]]:
    """Distinct tokens of a folded text that would be changed, with what they would become."""
    if text.isascii():
        return []
    around = dominant(text) or "Latin"
    if around == "Latin" and not FOREIGN.search(text):
        return []
    found = set(TOKEN.findall(text))
    if around == "Latin":
        found = {t for t in found if FOREIGN.search(t)}
    return sorted((t, better) for t in found if (better := repaired(t, around)) != t)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _look(text: str | None) -> bytes | None:
    return _digest(text) if text is not None and INK.search(text) else None


def unified(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, raw_hash, text_unified, changed, look) per row; ``look`` is the hash of the repaired text, by which equal-looking texts compare as equal, null for texts without a letter or digit."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def first(cols: dict) -> dict:
        raw = cols["text"].to_pylist()
        folded = [None if t is None else fold(t) for t in raw]
        doubts = [doubtful_tokens(t or "") for t in folded]
        return {
            "id": cols["id"],
            "raw_hash": [None if t is None else _digest(t) for t in raw],
            "folded": folded,
            "changed": [a != b for a, b in zip(raw, folded)],
            "mixed": [[{"token": t, "better": b} for t, b in d] for d in doubts],
            "look": [None if d else _look(t) for t, d in zip(folded, doubts)],
        }

    folded = written(map_arrow(rows, ["id", "text"], f"id {kind}, raw_hash binary, folded string, changed boolean, mixed array<struct<token:string,better:string>>, look binary", first), "folded")
    doubts = folded.select(F.explode("mixed").alias("m")).select("m.*").distinct()
    vocabulary = folded.select(F.explode(F.array_distinct(F.regexp_extract_all("folded", F.lit(r"\p{L}[\p{L}\x{300}-\x{36f}]*"), F.lit(0)))).alias("better")).distinct()
    spelled = doubts.groupBy("better").agg(F.count_distinct("token").alias("n")).filter("n > 1").select("better")
    known = doubts.join(vocabulary.unionByName(spelled).distinct(), "better", "left_semi")
    plan = (
        folded.filter(F.size("mixed") > 0)
        .select("id", "raw_hash", F.explode("mixed").alias("m"))
        .select("id", "raw_hash", "m.*")
        .join(known, ["token", "better"], "left_semi")
        .groupBy("id", "raw_hash")
        .agg(F.collect_set(F.struct("token", "better")).alias("swaps"))
    )

    def second(cols: dict) -> dict:
        texts, moved = [], []
        for t, swaps in zip(cols["folded"].to_pylist(), cols["swaps"].to_pylist()):
            swap = {s["token"]: s["better"] for s in swaps or ()}
            texts.append(TOKEN.sub(lambda m: swap.get(m[0], m[0]), t) if swap else t)
            moved.append(bool(swap))
        return {
            "id": cols["id"],
            "raw_hash": cols["raw_hash"],
            "text_unified": texts,
            "changed": [a or b for a, b in zip(cols["changed"].to_pylist(), moved)],
            "look": list(map(_look, texts)),
        }

    plain = folded.filter(F.size("mixed") == 0).select("id", "raw_hash", F.col("folded").alias("text_unified"), "changed", "look")
    again = folded.filter(F.size("mixed") > 0).join(plan, ["id", "raw_hash"], "left")
    return plain.unionByName(map_arrow(again, ["id", "raw_hash", "folded", "changed", "swaps"], f"id {kind}, raw_hash binary, text_unified string, changed boolean, look binary", second))


def lookalike_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_a, id_b), id_a < id_b: documents that look alike though their strings differ."""
    keyed = written(unified(df, id_col, text).filter(F.col("look").isNotNull()).select("id", "raw_hash", "look").distinct(), "looks")
    several = keyed.groupBy("look").agg(F.min("raw_hash").alias("a"), F.max("raw_hash").alias("b")).filter("a <> b").select("look")
    case = written(keyed.join(several, "look", "left_semi"), "cases")
    # different strings are paired first, their documents then: copies of one string never meet one another
    kinds = case.select("look", "raw_hash").distinct()
    left, right = kinds.withColumnRenamed("raw_hash", "a"), kinds.withColumnRenamed("raw_hash", "b")
    pairs = left.join(right, "look").filter("a < b")
    x, y = case.select("look", F.col("raw_hash").alias("a"), F.col("id").alias("x")), case.select("look", F.col("raw_hash").alias("b"), F.col("id").alias("y"))
    found = pairs.join(x, ["look", "a"]).join(y, ["look", "b"]).filter("x <> y")
    return found.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def look_classes(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_unified, changed, class_size), a row for each row of ``df``: its consistent form and how many documents look like it."""
    rows = written(unified(df, id_col, text), "unified")
    sizes = rows.filter(F.col("look").isNotNull()).select("look", "id").distinct().groupBy("look").agg(F.count(F.lit(1)).alias("class_size")).filter("class_size > 1")
    return rows.join(sizes, "look", "left").select("id", "text_unified", "changed", F.coalesce("class_size", F.lit(1)).alias("class_size"))
