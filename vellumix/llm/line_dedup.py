"""Problem 7: lines repeated over many documents of one source.

Method: content-defined chunking. Over the letters of the running text of a document, line ends
ignored, a rolling hash of the last ``WINDOW`` letters decides, by content alone, where a chunk ends; a
text repeated somewhere has the same chunks there, but for its first and last letters, whatever stands
around it. Documents are counted per (source, chunk). A line recurs only if the chunks that lie within
it do, hence the lines whose ``ANCHORS`` chunks of smallest hash recur are the candidates, and no case
can be lost; lines too short to hold a chunk of their own are candidates as well. The exact count by
whole line follows on the candidates.

Texts are cleaned by the same chunks: a chunk of a repeated line, wherever it occurs in a document of
its source, is extended to the letters of that line, and these are cut if they are the same, also where
the line's text stands inside a longer line. Repeated lines without a chunk of their own are cut only
as whole lines: inside others they are too short to be told from prose.

Scale: texts are read once and never shuffled; chunks are counted by deliveries, which is never less
than by documents, and pre-aggregated before the shuffle, so that a chunk found in a third of all
documents arrives as one row per task. A source has at most 20 recurring lines for every line of its
average document; to clean texts, this list of their source is joined to them.

Defined cases: null or blank sources and null ids take no part; null or empty texts have no lines;
lines without letters never count; deliveries of one id count as one document; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumix.storage import written

from .common import U64, code_points, list_array, map_arrow, mix64, sub_batches

WINDOW, MASK, ANCHORS = 5, U64(7), 2
BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
NOT_LETTER = re.compile(r"[\W\d_]+")
LINE_END = re.compile(r"\r?\n")


def letters(line: str) -> str:
    """The letters of a line in lower case."""
    kept = NOT_LETTER.sub("", line.lower())
    return kept if kept.isalpha() or not kept else "".join(c for c in kept if c.isalpha())


class Chunks:
    """Content-defined chunks of a run of letters, and hashes of any part of it."""

    def __init__(self, text: str):
        x = mix64(code_points(text).astype(U64) + U64(1))
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.full(len(x), BASE, dtype=U64))
            self.back = np.concatenate([[U64(1)], np.multiply.accumulate(np.full(len(x), INVERSE, dtype=U64))])  # INVERSE ** i
            self.total = np.concatenate([[U64(0)], np.cumsum(x * power, dtype=U64)])
            rolled = (self.total[WINDOW:] - self.total[:-WINDOW]) * self.back[: max(0, len(x) - WINDOW + 1)]
        #: places between two chunks; the letters that decide about a place are the WINDOW ones before it
        self.ends = np.flatnonzero((mix64(rolled) & MASK) == 0) + WINDOW if len(x) >= WINDOW else np.zeros(0, np.int64)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the letters begin .. end; equal letters have equal hashes wherever they stand."""
        with np.errstate(over="ignore"):
            return mix64((self.total[end] - self.total[begin]) * self.back[begin] + (end - begin).astype(U64)).view(np.int64)

    def within(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, number) for each line begin .. end: its own chunks are those from ``ends[first + i]`` to ``ends[first + i + 1]``."""
        first = np.searchsorted(self.ends, begin + WINDOW, side="left")
        return first, np.maximum(np.searchsorted(self.ends, end, side="right") - first - 1, 0)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... , count numbers for each, in one array."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)


def source_key(source: Column) -> Column:
    """Source without case and outer white space; null where nothing is left."""
    key = F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(key != "", key)


def _rows(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), source_key(F.col(source)).alias("source"), F.col(text).alias("text"))


def _chunked(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    """(id, source, lines: line_no, key, n, lead, chunks): chunks within a line, and the letters before the first of them."""
    rows = _rows(df, id_col, source, text).dropna()

    def work(cols: dict) -> dict:
        texts = cols["text"].to_pylist()
        numbers, per_doc, parts = [], [0], []
        for a, b in sub_batches(texts):
            kept: list[str] = []
            for t in texts[a:b]:
                n = 0
                for k, line in enumerate(LINE_END.split(t), 1):
                    if key := letters(line):
                        kept.append(key)
                        numbers.append(k)
                        n += 1
                per_doc.append(per_doc[-1] + n)
            for i, j in sub_batches(kept):
                run = Chunks("".join(kept[i:j]))
                end = np.cumsum([len(x) for x in kept[i:j]])
                begin = end - np.array([len(x) for x in kept[i:j]])
                first, count = run.within(begin, end)
                inner = _ranges(first, count)
                lead = np.where(count > 0, run.ends[np.minimum(first, max(0, len(run.ends) - 1))] - begin, -1) if len(run.ends) else np.full(len(end), -1)
                parts.append((run.hashes(begin, end), end - begin, lead, count, run.hashes(run.ends[inner], run.ends[inner + 1])))
        key, size, lead, count, hashes = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5
        inner = list_array(np.concatenate([[0], np.cumsum(count)]), hashes, pa.int64())
        fields = [pa.array(numbers, type=pa.int32()), pa.array(key), pa.array(size.astype(np.int32)), pa.array(lead.astype(np.int32)), inner]
        lines = pa.StructArray.from_arrays(fields, names=["line_no", "key", "n", "lead", "chunks"])
        return {"id": cols["id"], "source": cols["source"], "lines": pa.ListArray.from_arrays(pa.array(per_doc, type=pa.int32()), lines)}

    return map_arrow(rows, ["id", "source", "text"], "id string, source string, lines array<struct<line_no:int,key:bigint,n:int,lead:int,chunks:array<bigint>>>", work)


def _repeated(df: DataFrame, id_col: str, source: str, text: str, least: int, share: float) -> tuple[DataFrame, DataFrame]:
    """(lines that may recur: id, source, line_no, key), (those that do: source, key, n, lead, anchor)."""
    docs = written(_chunked(df, id_col, source, text), "lines")
    sizes = docs.select("source", "id").distinct().groupBy("source").count().select("source", F.greatest(F.lit(least), F.ceil(F.col("count") * share - 1e-9)).alias("needed"))
    sizes = written(sizes, "sizes")
    often = docs.select("source", F.explode(F.array_distinct(F.flatten("lines.chunks"))).alias("chunk")).groupBy("source", "chunk").count()
    often = written(often.join(sizes, "source").filter(F.col("count") >= F.col("needed")).select("source", "chunk"), "often")
    anchors = F.slice(F.array_sort(F.array_distinct("chunks")), 1, ANCHORS)
    lines = docs.select("id", "source", F.inline("lines")).select("id", "source", "line_no", "key", "n", "lead", F.get("chunks", F.lit(0)).alias("anchor"), anchors.alias("anchors"))
    line = ["id", "source", "line_no", "key", "n", "lead", "anchor"]
    hits = (
        lines.filter(F.size("anchors") > 0)
        .select(*line, F.size("anchors").alias("k"), F.explode("anchors").alias("chunk"))
        .join(often, ["source", "chunk"], "left_semi")
        .groupBy(*line, "k")
        .count()
        .filter(F.col("count") >= F.col("k"))
    )
    maybe = written(hits.select(*line).unionByName(lines.filter(F.size("anchors") == 0).select(*line)), "maybe")
    exact = maybe.select("source", "key", "n", "lead", "anchor", "id").distinct().groupBy("source", "key", "n", "lead", "anchor").count()
    return maybe, exact.join(sizes, "source").filter(F.col("count") >= F.col("needed")).select("source", "key", "n", "lead", "anchor")


def repeated_lines(df: DataFrame, id_col: str = "id", source: str = "source_archive", text: str = "text", least: int = 3, share: float = 0.05) -> DataFrame:
    """(id, source, line_no) of each line that recurs in >= ``least`` and >= ``share`` of its source's documents."""
    maybe, cases = _repeated(df, id_col, source, text, least, share)
    return maybe.join(cases.select("source", "key"), ["source", "key"]).select("id", "source", "line_no").distinct()


def _letter_places(line: str) -> list[int]:
    """Where each letter of ``letters(line)`` stands in the line."""
    return [k for k, c in enumerate(line) for _ in letters(c)]


def _cut(text: str, cases: list[dict]) -> tuple[str, int, int]:
    """(text without the repeated lines and their copies inside other lines, lines removed, copies removed)."""
    whole = {c["key"] for c in cases}
    by_anchor: dict[int, list[dict]] = {}
    for c in cases:
        if c["anchor"] is not None:
            by_anchor.setdefault(c["anchor"], []).append(c)
    parts = re.split(r"(?<=\n)", text)
    bare = [letters(p.removesuffix("\n").removesuffix("\r")) for p in parts]
    run = Chunks("".join(bare))
    end = np.cumsum([len(b) for b in bare])
    begin = end - np.array([len(b) for b in bare])
    keys = run.hashes(begin, end)
    drop = [bool(b) and k in whole for b, k in zip(bare, keys.tolist())]
    spans: dict[int, list[tuple[int, int]]] = {}
    if by_anchor and len(run.ends) > 1:
        chunk = run.hashes(run.ends[:-1], run.ends[1:])
        for t in np.flatnonzero(np.isin(chunk, np.fromiter(by_anchor, np.int64, len(by_anchor)))).tolist():
            k = int(np.searchsorted(end, run.ends[t], side="right"))
            for c in by_anchor[int(chunk[t])] if k < len(bare) and not drop[k] else ():
                a = int(run.ends[t]) - c["lead"]
                if a >= begin[k] and a + c["n"] <= end[k] and run.hashes(np.array([a]), np.array([a + c["n"]]))[0] == c["key"]:
                    spans.setdefault(k, []).append((a - int(begin[k]), a + c["n"] - int(begin[k])))
    out, inside = [], 0
    for k, part in enumerate(parts):
        if drop[k]:
            continue
        if k in spans:
            at, last = _letter_places(part), len(part)
            for a, b in sorted(set(spans[k]), reverse=True):
                if at[b - 1] < last:  # copies that overlap are cut once
                    part, last, inside = part[: at[a]] + part[at[b - 1] + 1 :], at[a], inside + 1
        out.append(part)
    return "".join(out), sum(drop), inside


def without_repeated_lines(df: DataFrame, id_col: str = "id", source: str = "source_archive", text: str = "text", least: int = 3, share: float = 0.05) -> DataFrame:
    """(id, source, text_clean, n_removed, n_inside), a row for each row of ``df`` with an id; nothing else of a text changes.

    ``n_removed`` counts whole lines, ``n_inside`` copies of repeated lines within other lines.
    """
    _, cases = _repeated(df, id_col, source, text, least, share)
    lists = written(cases.groupBy("source").agg(F.collect_set(F.struct("key", "n", "lead", "anchor")).alias("cases")), "cases")  # of a source at most 1 / share lines for each line of its average document
    rows = _rows(df, id_col, source, text).filter(F.col("id").isNotNull()).join(lists, "source", "left")

    def work(cols: dict) -> dict:
        done = [(t, 0, 0) if t is None or not cases else _cut(t, cases) for t, cases in zip(cols["text"].to_pylist(), cols["cases"].to_pylist())]
        texts, removed, inside = zip(*done) if done else ((), (), ())
        return {"id": cols["id"], "source": cols["source"], "text_clean": list(texts), "n_removed": list(removed), "n_inside": list(inside)}

    return map_arrow(rows, ["id", "source", "text", "cases"], "id string, source string, text_clean string, n_removed int, n_inside int", work)
