"""Problem 6: cut oversized texts at natural boundaries into pieces within a limit, with overlap.

Method: structure-tree packing. A text is a tree: sections (headings or mark-up blocks), paragraphs,
lines and list items, sentences, clauses, words, characters. A node within the limit stays whole;
only an oversized node is opened, and neighbouring subtrees are merged from the bottom up while they
fit. Every piece but the first starts with the end of the piece before it: its last
``overlap_words`` words, or its last ``overlap_chars`` characters if those words are longer.

Defined cases: a null text gives no piece; an empty or blank text within the limit gives one piece
equal to itself; a text without any place to cut is cut between characters; repeated rows are cut
once. ``piece[overlap:]`` of all pieces, joined, is the text. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, distinct_items, map_arrow

WORD = re.compile(f"[^{WHITE}]+")
_NAMED = r"(?:chapter|kapitel|chapitre|cap[ií]tulo|part)\b"
#: Where a node of each level ends, from the top of the tree to its leaves: headings by their depth, named
#: chapters as the first, rules as the last of them, then paragraphs, lines and list items, sentences,
#: clauses and words.
LEVELS = [
    *(re.compile(rf"\n(?=[ \t]*(?:#{{1,{depth}}} |<h[1-{depth}]\b|{_NAMED}))", re.IGNORECASE) for depth in range(1, 7)),
    re.compile(r"\n(?=[ \t]*[=\-*_]{3,})"),
    re.compile(r"\n[ \t\r]*\n\s*|</p>\s*|</div>\s*"),
    re.compile(r"\r?\n|<br ?/?>"),
    re.compile(rf"[.!?…]+[\"'”’»)\]]*[{WHITE}]+|[。！？]+[」』）]*"),
    re.compile(rf"[,;:—]+[{WHITE}]+|[、，；：]"),
    re.compile(f"[{WHITE}]+"),
]


def pieces(text: str, max_words: int = 350, max_chars: int = 2400, overlap_words: int = 30, overlap_chars: int = 240) -> list[tuple[str, int]]:
    """(piece, length of what it repeats) in order; one piece if the text is within the limit."""
    starts = np.array([m.start() for m in WORD.finditer(text)], dtype=np.int64)
    inside = np.array([m.end() for m in WORD.finditer(text)], dtype=np.int64)

    def words(a: int, b: int) -> int:
        i = np.searchsorted(starts, a)
        return int(np.searchsorted(starts, b) - i) + int(i > 0 and inside[i - 1] > a and b > a)

    if len(starts) <= max_words and len(text) <= max_chars:
        return [(text, 0)]
    most_words, most_chars = max(1, max_words - overlap_words), max(1, max_chars - overlap_chars)
    fits = lambda a, b: b - a <= most_chars and words(a, b) <= most_words

    def packed(a: int, b: int, level: int) -> list[tuple[int, int]]:
        if fits(a, b):
            return [(a, b)]
        if level == len(LEVELS):
            return [(i, min(i + most_chars, b)) for i in range(a, b, most_chars)]
        cuts = [m.end() for m in LEVELS[level].finditer(text, a, b) if a < m.end() < b]
        out: list[tuple[int, int]] = []
        for i, j in zip([a, *cuts], [*cuts, b]):
            for part in packed(i, j, level + 1):
                if out and fits(out[-1][0], part[1]):
                    out[-1] = (out[-1][0], part[1])
                else:
                    out.append(part)
        return out

    def tail(a: int, b: int) -> int:
        """Where the repeated end of the piece a..b begins."""
        last = np.searchsorted(starts, b) - overlap_words
        at = int(starts[last]) if last >= 0 else a
        return max(a, at, b - overlap_chars) if overlap_words and overlap_chars else b

    spans = packed(0, len(text), 0)
    froms = [0] + [tail(a, b) for a, b in spans[:-1]]
    return [(text[f:b], a - f) for f, (a, b) in zip(froms, spans)]


def split_items(df: DataFrame, keys: list[str], text: str = "text", **limits) -> DataFrame:
    """Pieces of every item: keys, piece_no (from 0), n_pieces, piece, overlap, n_words, n_chars; repeated rows are cut once."""
    return _split(distinct_items(df.select(*keys, F.col(text).alias("_text")).filter(F.col("_text").isNotNull()), keys, "_text"), keys, **limits)


def _split(items: DataFrame, keys: list[str], **limits) -> DataFrame:
    kinds = dict(items.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", pieces array<struct<piece:string,overlap:int,n_words:int,n_chars:int>>"

    def work(cols: dict) -> dict:
        cut = [[{"piece": p, "overlap": o, "n_words": len(WORD.findall(p)), "n_chars": len(p)} for p, o in pieces(t, **limits)] for t in cols["_text"].to_pylist()]
        return {k: cols[k] for k in keys} | {"pieces": cut}

    cut = map_arrow(items, [*keys, "_text"], schema, work)
    return cut.select(*keys, F.size("pieces").alias("n_pieces"), F.posexplode("pieces").alias("piece_no", "p")).select(*keys, "piece_no", "n_pieces", "p.*")


def oversized(df: DataFrame, keys: list[str], text: str = "text", **limits) -> DataFrame:
    """Keys of the items that had to be cut; only keys are shuffled."""
    items = df.select(*keys, F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    return _split(items, keys, **limits).filter((F.col("piece_no") == 0) & (F.col("n_pieces") > 1)).select(*keys).distinct()
