"""Problem 1: statistics of every text, and fixed-threshold rules that tell prose from the rest.

Method: length, symbol, digit, punctuation, bullet and common-word statistics are computed with
vectorised counts over the code points of a whole batch and over its runs of words; published kinds
of fixed thresholds (symbol and digit ratio, odd tokens, common-word share, repetition) are then
applied to each part of a text, and the reason is recorded for each part that fails. A text is not
prose if the failing parts hold more than half of its characters.

A part is a line with a rule of its own (marks, digits, odd tokens) or a run of neighbouring lines of
at least ``RUN_WORDS`` words; so verse and dialogue in short lines is judged as a whole. Texts of
fewer than ``MIN_WORDS`` words fail only by their characters.

The shares of bullet lines and of lines with an end mark and the mean word length are given as
statistics only; no rule uses them. A bullet list passes if its entries hold enough common words or
are Japanese.

Defined cases: null texts give null statistics and are not reported; empty and blank texts give
zeros and count as prose (nothing in them is unreadable); repeated rows give repeated results.
Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_points, map_arrow, sub_batches

MIN_WORDS, RUN_WORDS, WINDOW = 12, 40, 60
MAX_SYMBOLS, MAX_DIGITS, MAX_ODD_TOKENS = 0.10, 0.20, 0.25
MIN_COMMON, MIN_DISTINCT = 0.12, 0.20
#: Frequent function words of the languages of the data.
FUNCTION_WORDS = {
    "en": "the a an and or but of to in on at by for with from as is was were be been it he she they his her their that this not no had have who what nobody i you me said when would so than more",
    "fr": "le la les un une des du de et ou mais à dans sur par pour avec il elle ils que qui ne pas se sa son ses au aux était sous entre où",
    "de": "der die das ein eine einen einem den dem des und oder aber zu im am an auf von mit für er sie es war nicht wie sich lag niemand zwischen über",
    "es": "el la los las una y o pero en de por para con su sus que no se lo del al era entre sobre nadie cuando como más",
    "ru": "и в на с не что он она они как его её их из за по к у от но же бы был была было это только никто через под над между",
    "el": "ο η το οι τα τον την του της των και σε στο στη στην στον με για από που δεν ήταν να θα μια ένα ένας πάνω κάτω",
}
COMMON = frozenset(" ".join(FUNCTION_WORDS.values()).split())
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
BULLET = re.compile(r"\s*(?:[-*•·–▪●◦+>]|\d{1,3}[.)]|[a-z]\))\s+\S")
SENTENCE = re.compile(r"[.!?…。！？]+[\"'”’»)\]]*(?:\s+|$)|[。！？]")
QUOTED = re.compile(r"[\"“„«「][^\"“”„«»「」]+[\"”“»」]")
ENDS = tuple(".!?…:;,\"'”’»)。！？」—")
ODD_TOKEN = re.compile(r"(?=\S*[^\W\d_])(?=\S*[\d_=\\/{}\[\]<>|#~^@%+*!])[^\W_]\S*[\d_=\\/{}\[\]<>|#~^@%+*!]\S*[^\W_]?")
KANA = re.compile("[\\u3040-\\u309f]")


_BY_LANGUAGE = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}


def guess_language(text: str) -> str:
    """The language whose function words are most frequent; ja by its kana; und where none occurs."""
    if not text.isascii() and len(KANA.findall(text)) > 0.1 * len(text):
        return "ja"
    words = text.lower().split()
    hits = {k: sum(w in v for w in words) for k, v in _BY_LANGUAGE.items()}
    best = max(hits, key=hits.get)
    return best if hits[best] else "und"


def _classes() -> np.ndarray:
    """For each code point of the basic plane: 0 blank, 1 letter or mark, 2 digit, 3 usual punctuation, 4 symbol."""
    import unicodedata

    table = np.full(0x10000, 1, np.uint8)
    for cp in range(0x3100):
        c = chr(cp)
        kind = unicodedata.category(c)
        table[cp] = 0 if c.isspace() or kind in ("Cf", "Cc") else 2 if kind == "Nd" else 1 if kind[0] in "LM" else 4
    for c in ".,:;!?'\"()-–—…«»„“”‚‘’‹›¿¡&·、。「」『』・ー":
        table[ord(c)] = 3
    for cp in range(0xFF00, 0xFF66):
        table[cp] = 3 if unicodedata.category(chr(cp))[0] == "P" else 1
    for cp in range(0xFF10, 0xFF1A):
        table[cp] = 2
    return table


_TABLE: list[np.ndarray] = []


def _counts(texts: list[str]) -> np.ndarray:
    """A row of five class counts for each text."""
    if not _TABLE:
        _TABLE.append(_classes())
    out = np.zeros((len(texts), 5), np.int64)
    for a, b in sub_batches(texts):
        cp = code_points("".join(texts[a:b]))
        kind = np.where(cp < 0x10000, _TABLE[0][np.minimum(cp, 0xFFFF)], 4).astype(np.uint8)
        ends = np.cumsum([len(t) for t in texts[a:b]])
        for k in range(5):
            total = np.concatenate([[0], np.cumsum(kind == k)])
            out[a:b, k] = np.diff(np.concatenate([[0], total[ends]]))
    return out


def _line_reason(line: str, counts: np.ndarray) -> str | None:
    """The rule of its own that a line fails, if any. counts: blank, letter, digit, punctuation, symbol."""
    seen = counts[1:].sum()
    if not seen:
        return None
    if counts[4] > MAX_SYMBOLS * seen:
        return "symbols"
    if counts[2] > MAX_DIGITS * seen:
        return "digits"
    tokens = line.split()
    if (counts[4] or counts[2]) and sum(bool(ODD_TOKEN.fullmatch(t)) for t in tokens) > MAX_ODD_TOKENS * len(tokens):
        return "odd_tokens"
    return None


def _run_reason(words: list[str], japanese: bool) -> str | None:
    """The rule that a run of lines fails, if any."""
    if len(words) >= WINDOW // 2 and len(set(words)) < MIN_DISTINCT * len(words):
        return "repetition"
    if not japanese and len(words) >= MIN_WORDS and sum(w in COMMON for w in words) < MIN_COMMON * len(words):
        return "no_common_words"
    return None


def judge(text: str) -> dict:
    """Statistics and the reasons of one text."""
    lines = [x for x in text.splitlines() if x.strip()]
    by_line = _counts(lines)
    total = by_line.sum(axis=0)
    words = WORD.findall(text.lower())
    seen = int(total[1:].sum())
    failed: dict[str, int] = {}
    run_words: list[str] = []
    run_lines: list[str] = []
    pending: list[tuple[list[str], list[str]]] = []
    for line, counts in zip(lines, by_line):
        if reason := _line_reason(line, counts):
            failed[reason] = failed.get(reason, 0) + int(counts[1:].sum())
            continue
        run_lines.append(line)
        run_words += WORD.findall(line.lower())
        if len(run_words) >= RUN_WORDS:
            pending.append((run_lines, run_words))
            run_lines, run_words = [], []
    if run_lines:
        if pending and len(run_words) < MIN_WORDS:
            pending[-1] = (pending[-1][0] + run_lines, pending[-1][1] + run_words)
        else:
            pending.append((run_lines, run_words))
    for ls, ws in pending:
        # a long run is judged in windows, so that a list inside prose counts by itself
        parts = max(1, len(ws) // WINDOW)
        size = sum(len(w) for line in ls for w in line.split())
        japanese = sum(len(KANA.findall(line)) for line in ls) > 0.2 * size
        for k in range(parts):
            a, b = len(ws) * k // parts, len(ws) * (k + 1) // parts
            if reason := _run_reason(ws[a:b], japanese):
                failed[reason] = failed.get(reason, 0) + int(round(size / parts))
    sentences = max(1, sum(1 for x in SENTENCE.split(text) if x.strip())) if words else 0
    quoted = sum(len(WORD.findall(q)) for q in QUOTED.findall(text))
    share = min(1.0, sum(failed.values()) / seen) if seen else 0.0
    n = len(words)
    return {
        "n_words": n,
        "n_chars": len(text),
        "n_lines": len(lines),
        "mean_word_len": sum(map(len, words)) / n if n else 0.0,
        "symbol_ratio": float(total[4] / seen) if seen else 0.0,
        "digit_ratio": float(total[2] / seen) if seen else 0.0,
        "punct_end_share": sum(x.rstrip().endswith(ENDS) for x in lines) / len(lines) if lines else 0.0,
        "bullet_share": sum(bool(BULLET.match(x)) for x in lines) / len(lines) if lines else 0.0,
        "common_share": sum(w in COMMON for w in words) / n if n else 0.0,
        "avg_sentence_len": n / sentences if n else 0.0,
        "dialogue_ratio": quoted / n if n else 0.0,
        "ttr": len(set(words)) / n if n else 0.0,
        "junk_share": share,
        "reasons": sorted(failed),
        "is_prose": share <= 0.5,
    }


SCHEMA = "n_words int, n_chars int, n_lines int, mean_word_len double, symbol_ratio double, digit_ratio double, punct_end_share double, bullet_share double, common_share double, avg_sentence_len double, dialogue_ratio double, ttr double, junk_share double, reasons array<string>, is_prose boolean"
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def text_statistics(df: DataFrame, id_col: str = "id", text: str = "preview") -> DataFrame:
    """A row of statistics with reasons for each row of ``df``."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def work(cols: dict) -> dict:
        found = [judge(t) if t is not None else dict.fromkeys(NAMES) for t in cols["text"].to_pylist()]
        return {"id": cols["id"]} | {k: [f[k] for f in found] for k in NAMES}

    return map_arrow(rows, ["id", "text"], f"id {kind}, {SCHEMA}", work)


def not_prose(df: DataFrame, id_col: str = "id", text: str = "preview") -> DataFrame:
    """Ids of the texts of which more than half fails a rule."""
    return text_statistics(df, id_col, text).filter(~F.col("is_prose")).select("id").distinct()


def compared(df: DataFrame) -> DataFrame:
    """Fresh statistics of each story beside those measured earlier; ``outdated`` where the word counts differ."""
    fresh = text_statistics(df)
    old = df.select("id", F.col("word_count").alias("old_word_count"), F.col("avg_sentence_len").alias("old_avg_sentence_len"), F.col("dialogue_ratio").alias("old_dialogue_ratio"), F.col("ttr").alias("old_ttr"))
    return fresh.join(old, "id").withColumn("outdated", ~F.col("n_words").eqNullSafe(F.col("old_word_count")))
