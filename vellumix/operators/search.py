"""Search of a vector index by text, with any encoder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import normalized, problem_of, top_k


class SearchEngine:
    """An index (id, chunk_index, embedding) and an encoder of texts into vectors of the same length.

    ``encode`` takes a frame and the name of its text column and returns it with ``embedding``.
    """

    def __init__(self, index: DataFrame, encode: Callable[[DataFrame, str], DataFrame], dim: int, most: int | None = None):
        rows = index.select("id", "chunk_index", "embedding").filter(F.coalesce(problem_of(F.col("embedding"), dim), F.lit("zero")) == "zero")
        rows = rows.orderBy("id", "chunk_index").limit(most) if most else rows
        if rows.isEmpty():
            raise ValueError("the index is empty")
        self.encode, self.dim = encode, dim
        self.rows = rows.withColumn("key", F.struct("id", "chunk_index")).withColumn("embedding", normalized(F.col("embedding")))

    def search(self, query: str, k: int = 10) -> DataFrame:
        """(id, chunk_index, score, rank) of the k chunks nearest to a text."""
        if k <= 0:
            raise ValueError("k must be positive")
        spark = self.rows.sparkSession
        asked = self.encode(spark.createDataFrame([(-1, query)], "hit bigint, text string"), "text")
        size = asked.select(F.size("embedding")).first()[0]
        if size != self.dim:
            raise ValueError(f"the encoder gives {size} numbers, the index has {self.dim}")
        # one number stands for (id, chunk_index): chunk indexes are 16-bit
        one = self.rows.select((F.col("id") * 65536 + F.col("chunk_index")).alias("hit"), "embedding")
        best = top_k(one, asked.select("hit", F.col("embedding").cast("array<double>").alias("embedding")), "hit", "embedding", k, self.dim)
        return best.select(F.floor(F.col("id") / 65536).cast("bigint").alias("id"), F.pmod("id", F.lit(65536)).cast("smallint").alias("chunk_index"), "score", "rank")
