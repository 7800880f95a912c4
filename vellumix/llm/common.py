"""Small vectorised helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

U64 = np.uint64
#: Bytes of an Arrow batch that a task hands to Python.
BATCH_BYTES = 32 << 20
#: Unicode White_Space, as the body of a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(U64)
        x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(32))


def code_points(text: str) -> np.ndarray:
    """The code points of a text; lone surrogates stay as they are."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def sub_batches(texts: list[str], budget: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``budget`` characters, so that arrays stay small."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > budget:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows and about ``size`` bytes of text; a longer row is a range by itself."""
    total = np.zeros(batch.num_rows, np.int64)
    for col in batch.columns:
        if pa.types.is_string(col.type) or pa.types.is_binary(col.type) or pa.types.is_large_string(col.type):
            total += np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(total)])
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, min(a + rows, int(np.searchsorted(upto, upto[a] + size, side="right")) - 1))
        yield a, min(b, batch.num_rows)
        a = b


def map_arrow(df, names: list[str], schema: str, work: Callable[[dict], dict], rows: int = 2000, size: int = 8 << 20):
    """``df.mapInArrow`` of ``work``: dict of Arrow columns in, dict of equally long columns out.

    ``work`` sees slices of bounded rows and bytes, so that long texts do not add up in memory.
    """
    spark = df.sparkSession
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark_schema = spark.createDataFrame([], schema).schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        for whole in batches:
            for a, b in _slices(whole, rows, size):
                batch = whole.slice(a, b - a)
                out = work({n: batch.column(i) for i, n in enumerate(names)})
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip((out[f.name] for f in arrow), arrow)], schema=arrow)

    return df.select(*names).mapInArrow(run, spark_schema)


def distinct_items(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``df`` (keys and one text) without repeated rows.

    Only keys and hashes of all rows are counted; the rows that occur more than once are then made
    distinct by themselves. Where Spark finds these few enough to broadcast, no other text is shuffled.
    """
    own = [*keys, "_h1", "_h2"]
    hashed = df.withColumns({"_h1": F.xxhash64(F.lit(1), text), "_h2": F.xxhash64(F.lit(2), text)})
    twice = hashed.groupBy(*own).count().filter("count > 1").select(*[F.col(c).alias(f"_twice_{c}") for c in own])
    same = [F.col(c).eqNullSafe(F.col(f"_twice_{c}")) for c in own]
    flagged = hashed.join(twice, same, "left").withColumn("_twice", F.col("_twice__h1").isNotNull()).select(*hashed.columns, "_twice")
    once = flagged.filter("NOT _twice").select(*df.columns)
    return once.unionByName(flagged.filter("_twice").dropDuplicates(own).select(*df.columns))


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from numpy offsets and values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))
