"""Readers of documents, chunks and vectors."""

from __future__ import annotations

import csv
import io

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vellumix import schemas
from vellumix.functions.text import author_or_unknown, header_author, header_title, text_or_empty, title_or_slug
from vellumix.operators.vectors import validated
from vellumix.storage import written


def _limited(df: DataFrame, limit: int | None, order: str = "id") -> DataFrame:
    return df.orderBy(order).limit(limit) if limit else df


def read_json(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """An array of documents or a single one per file."""
    return _limited(spark.read.schema(schemas.RAW_DOCUMENT).json(path, multiLine=True), limit)


def read_jsonl(spark: SparkSession, path: str, limit: int | None = None, strict: bool = True) -> DataFrame:
    """One document per line; blank lines are skipped; a malformed line fails unless ``strict`` is off, then it is dropped."""
    return _limited(spark.read.schema(schemas.RAW_DOCUMENT).json(path, mode="FAILFAST" if strict else "DROPMALFORMED"), limit)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The corpus CSV by its header, all strings; quoted fields may hold newlines and doubled quotes; short rows are padded with null, longer ones cut. Line ends inside a field come out as newlines.

    Whether a newline ends a row depends on all quotes before it in the file, so Spark's own multi-line
    reader takes a file in one task. Here a file is split at lines: the quotes of each split are counted,
    their running sum tells whether a split begins inside a field, and the lines are then numbered by the
    row that they belong to and put together by it. The file is read several times; nothing is brought to one task but
    a count for each split of a file.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.spark_partition_id().alias("split"), F.monotonically_increasing_id().alias("line"))
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    lines = lines.withColumn("odd", odd)
    # the quotes of a file before each of its splits, and the splits of a file in order; a row for each split
    of_split = written(lines.groupBy("file", "split").agg(F.sum("odd").alias("quotes"), F.min("line").alias("first")), "splits")
    earlier = Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    inside = of_split.select("file", "split", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("inside"))
    # within a split: the running parity before each line, then the number of the row begun last
    upto = Window.partitionBy("file", "split").orderBy("line")
    stated = lines.join(inside, ["file", "split"]).withColumn("before", F.pmod(F.col("inside") + F.coalesce(F.sum("odd").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2)))
    begun = stated.withColumn("row", F.max(F.when(F.col("before") == 0, F.col("line"))).over(upto))
    # lines at the head of a split that continue a row of an earlier one
    last = written(begun.groupBy("file", "split").agg(F.max("row").alias("last")), "rows")
    carried = last.select("file", "split", F.last("last", True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    whole = begun.join(carried, ["file", "split"]).withColumn("row", F.coalesce("row", "carried"))
    parts = F.array_sort(F.collect_list(F.struct("line", "value")))
    rows = whole.groupBy("file", "row").agg(F.array_join(F.transform(parts, lambda x: x.value), "\n").alias("text"))
    heads = rows.join(of_split.groupBy("file").agg(F.min("first").alias("row")), ["file", "row"], "left_semi")
    header = heads.select("text").first()
    names = next(csv.reader(io.StringIO(header.text.removeprefix("\ufeff")))) if header else []
    if not names:
        return spark.createDataFrame([], "value string")
    schema = ", ".join(f"`{n}` string" for n in names)
    body = rows.join(heads.select("file", "row"), ["file", "row"], "left_anti").filter(F.trim("text") != "")

    def parse(batches):
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            cells = [next(csv.reader(io.StringIO(t, newline="")), []) for t in batch.column(0).to_pylist()]
            columns = [pa.array([c[k] if k < len(c) else None for c in cells], pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return body.select("text").mapInArrow(parse, schema)


def documents_from_csv(rows: DataFrame, archive: str = "archive") -> DataFrame:
    """CSV rows mapped to documents; unknown titles and authors come from slug and header lines."""
    have = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in rows.columns], F.lit(None).cast("string"))
    text = text_or_empty(have("content", "text"))
    title = title_or_slug(have("title"), have("story_slug"))
    author = author_or_unknown(have("author_name", "author"))
    open_title = F.when(title == "Untitled Story", F.lit("")).otherwise(title)
    found_title = header_title(text, open_title)
    return rows.select(
        have("id").alias("id"),
        F.when(found_title == "", title).otherwise(found_title).alias("title"),
        header_author(text, author).alias("author"),
        text.alias("text"),
        F.filter(F.array(have("orientation"), have("category")), lambda x: x.isNotNull()).alias("tags"),
        have("url").alias("source_url"),
        F.lit(archive).alias("source_archive"),
        have("publication_date", "created_at").alias("created_date"),
        F.create_map(*[x for k, n in (("path", "path"), ("category", "category"), ("slug", "story_slug"), ("chapter_num", "chapter_num")) for x in (F.lit(k), have(n))]).alias("raw_metadata"),
    )


def split_ids(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows with a whole number as id (cast), and the others with an error message."""
    number = F.col(id_col).try_cast("bigint")
    good = df.filter(number.isNotNull()).withColumn(id_col, number)
    bad = df.filter(number.isNull()).withColumn("error", F.concat(F.lit("not a number: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return good, bad


def read_vectors(spark: SparkSession, path: str, dim: int, check: bool = True) -> DataFrame:
    """The three columns of a search from a directory of Parquet shards; unusable rows fail the read."""
    df = spark.read.parquet(path)
    missing = [c for c in ("id", "chunk_index", "embedding") if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    df = df.select("id", "chunk_index", "embedding")
    return validated(df, "embedding", dim) if check else df


def read_chunk_lines(spark: SparkSession, path: str) -> DataFrame:
    """Chunks from JSON lines (id, content); chunks of one id are numbered from 0 in file order.

    Malformed lines, missing ids and empty contents fail with the line's place.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line")).filter(F.trim("value") != "")
    parsed = lines.withColumn("j", F.from_json("value", schemas.CHUNK_LINE))
    ok = F.col("j.id").isNotNull() & (F.trim("j.content") != "")
    checked = parsed.withColumn("id", F.when(ok, F.col("j.id")).otherwise(F.raise_error(F.concat(F.lit("bad chunk line: "), F.substring("value", 1, 80)))))
    index = F.row_number().over(Window.partitionBy("id").orderBy("line")) - 1
    return checked.select("id", index.cast("smallint").alias("chunk_index"), F.col("j.content").alias("chunk_text"), "line").drop("line")


@F.pandas_udf(StringType())
def inflated(s: pd.Series) -> pd.Series:
    """zlib-compressed UTF-8 of a binary column as text; empty where it can't be read."""
    import zlib

    def one(b: bytes | None) -> str:
        try:
            return zlib.decompress(bytes(b)).decode("utf-8", "replace") if b else ""
        except zlib.error:
            return ""

    return s.map(one)


def deflate_udf():
    """A function of text: zlib-compressed UTF-8 at the fastest level."""
    import zlib

    @F.pandas_udf("binary")
    def deflated(s: pd.Series) -> pd.Series:
        return s.map(lambda t: zlib.compress(t.encode(), 1) if t is not None else None)

    return deflated


def from_base64(c: str) -> Column:
    """Inflated text of a base64 column; empty for null or malformed input."""
    return inflated(F.expr(f"try_to_binary({c}, 'base64')"))


def page_after(df: DataFrame, last_id: int, size: int, key: str = "id") -> DataFrame:
    """The next rows after an id, in its order; pushed down to the scan and the top-k."""
    return df.filter(F.col(key) > last_id).orderBy(key).limit(size)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole files of a directory as (path, content), for documents parsed elsewhere."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
