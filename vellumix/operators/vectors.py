"""Vector columns: validation, normalisation, exact similarity search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumix.functions.text import let

#: Bytes of queries that may go to every task; more are answered in several passes.
QUERY_BYTES = 32 << 20
#: Similarities that a task holds at once.
TILE = 4 << 20


def problem_of(vector: Column, dim: int) -> Column:
    """Why a vector is unusable, or null: null, length, null_element, non_finite, zero."""
    bad = F.exists(vector, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.when(vector.isNull(), "null")
        .when(F.size(vector) != dim, "length")
        .when(F.exists(vector, lambda x: x.isNull()), "null_element")
        .when(bad, "non_finite")
        .when(~F.exists(vector, lambda x: x != 0), "zero")
    )


def validated(df: DataFrame, vector: str, dim: int, columns: tuple[str, ...] = ()) -> DataFrame:
    """``df``, whose reading fails at the first unusable vector; missing columns fail at once."""
    missing = [c for c in (*columns, vector) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    why = problem_of(F.col(vector), dim)
    return df.withColumn(vector, F.when(why.isNull() | (why == "zero"), F.col(vector)).otherwise(F.raise_error(F.concat(F.lit("unusable vector: "), why))))


def normalized(vector: Column) -> Column:
    """Unit length in double precision; the zero vector stays zero."""
    def divided(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        return let(norm, lambda n: F.when(n == 0, v).otherwise(F.transform(v, lambda x: x / n)))

    return let(F.transform(vector, lambda x: x.cast("double")), divided)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of unit vectors within [-1, 1]; 0 if the lengths differ or are 0."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))).otherwise(0.0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(pc.cast(column.flatten(), pa.float64())).reshape(-1, dim)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def top_k(items: DataFrame, queries: DataFrame, id_col: str, vector: str, k: int, dim: int, exclude_self: bool = True) -> DataFrame:
    """(query_id, id, score, rank): the k most similar items of every query, exact; ties by id.

    Queries (same columns as items) are sent to every task in blocks of at most ``QUERY_BYTES``; a
    task multiplies matrices and keeps its k best of each query, so that only k rows of a task and
    query are shuffled.
    """
    usable = lambda df: df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v")).filter(problem_of(F.col("v"), dim).isNull())
    base, asked = usable(items), usable(queries)
    size = max(1, QUERY_BYTES // (8 * dim))
    n = asked.count()
    blocks = max(1, -(-n // size))
    out = None
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()  # at most about QUERY_BYTES
        ids = np.array([r.id for r in part], np.int64)
        q = np.array([r.v for r in part], np.float64).reshape(-1, dim)
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)

        def best(batches, ids=ids, q=q):
            s, i = np.full((len(q), k), -9.0), np.zeros((len(q), k), np.int64)
            for batch in batches:
                own = np.asarray(batch.column(0))
                x = _matrix(batch.column(1), dim)
                for a in range(0, len(x), 1024):
                    part, names = x[a : a + 1024], own[a : a + 1024]
                    for c in range(0, len(q), TILE // 1024):
                        at = slice(c, c + TILE // 1024)
                        sims = np.round(q[at] @ part.T, 12)
                        if exclude_self:
                            sims[names[None, :] == ids[at, None]] = -9.0
                        # only what reaches the k-th so far can enter; equal ones are decided by their ids
                        row, col = np.nonzero((sims >= s[at, -1:]) & (sims > -5))
                        if not len(row):
                            continue
                        hit = np.unique(row)
                        rows = np.concatenate([np.repeat(hit, k), row])
                        both = np.concatenate([s[at][hit].ravel(), sims[row, col]])
                        who = np.concatenate([i[at][hit].ravel(), names[col]])
                        order = np.lexsort((who, -both, rows))
                        rows, both, who = rows[order], both[order], who[order]
                        first = np.searchsorted(rows, hit)
                        best_k = first[:, None] + np.arange(k)
                        s[c + hit], i[c + hit] = both[best_k], who[best_k]
            who = np.repeat(ids, k)
            good = s.ravel() > -5
            yield pa.RecordBatch.from_arrays([pa.array(who[good]), pa.array(i.ravel()[good]), pa.array(s.ravel()[good])], names=["query_id", "id", "score"])

        found = base.mapInArrow(best, "query_id bigint, id bigint, score double")
        out = found if out is None else out.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k)


def zipped(df: DataFrame, texts: str, vectors: str, keys: list[str], skip_empty: bool = False) -> DataFrame:
    """One row for each position of a list of texts and its list of vectors; unequal lengths fail."""
    same = F.size(texts) == F.size(vectors)
    pairs = F.when(same, F.arrays_zip(F.col(texts).alias("text"), F.col(vectors).alias("vector"))).otherwise(F.raise_error(F.lit("texts and vectors differ in number")))
    out = df.select(*keys, F.posexplode(pairs).alias("chunk_index", "z")).select(*keys, "chunk_index", F.col("z.text").alias("chunk_text"), F.col("z.vector").alias("embedding"))
    return out.filter(F.size("embedding") > 0) if skip_empty else out
