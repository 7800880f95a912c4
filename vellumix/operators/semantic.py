"""Latent semantic analysis and topic clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from vellumix.storage import written

from .vectors import top_k


def features(text: str = "text", vocabulary: int = 2000, least_docs: float = 3, most_share: float = 0.5) -> Pipeline:
    """One- and two-word counts without stop words, weighted by IDF, of unit length."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=2),
            StopWordsRemover(inputCol="_tok", outputCol="_words"),
            NGram(n=2, inputCol="_words", outputCol="_pairs"),
            SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _all FROM __THIS__"),
            CountVectorizer(inputCol="_all", outputCol="counts", vocabSize=vocabulary, minDF=least_docs, maxDF=most_share),
            IDF(inputCol="counts", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="features", p=2.0),
        ]
    )


class Lsa:
    """Features projected to the leading right singular vectors, of unit length again."""

    def __init__(self, model: PipelineModel, basis: list[list[float]]):
        self.model, self.basis = model, basis

    @classmethod
    def fit(cls, df: DataFrame, text: str = "text", dims: int = 32, rounds: int = 3, seed: int = 0, **options) -> Lsa:
        """Randomised subspace iteration: each round is one pass in which every task sends one small block.

        A block has a row for each feature and a column for each direction sought, whatever the number
        of texts; so has the state of the driver.
        """
        model = features(text, **options).fit(df)
        size = len(model.stages[4].vocabulary)
        if not size:
            return cls(model, [])
        rows = written(model.transform(df).select(vector_to_array("features", "float32").alias("x")), "features")
        n = min(size, dims + 8)
        basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, n)))[0]
        names = [f"c{k}" for k in range(n)]

        def through(q: np.ndarray) -> np.ndarray:
            """The Gram matrix of the features times q."""

            def work(batches):
                total = np.zeros((size, n))
                for b in batches:
                    x = np.asarray(b.column(0).flatten()).reshape(-1, size).astype(np.float64)
                    total += x.T @ (x @ q)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), *(pa.array(total[:, k]) for k in range(n))], names=["i", *names])

            sums = rows.mapInArrow(work, "i int, " + ", ".join(f"{c} double" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names])
            out = np.zeros((size, n))
            for r in sums.collect():  # features x directions, both parameters
                out[r.i] = r[1:]
            return out

        for _ in range(rounds):
            basis = np.linalg.qr(through(basis))[0]
        values, turn = np.linalg.eigh(basis.T @ through(basis))
        return cls(model, (basis @ turn[:, np.argsort(-values)[: max(2, min(dims, size))]]).tolist())

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``topic_vector``."""
        basis = df.sparkSession.sparkContext.broadcast(np.array(self.basis))

        @F.pandas_udf(ArrayType(DoubleType()))
        def project(s: pd.Series) -> pd.Series:
            x = np.stack(s.to_numpy()) @ basis.value if len(s) else np.zeros((0, 1))
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            return pd.Series(list(x / np.where(norm == 0, 1, norm)))

        helpers = ["_tok", "_words", "_pairs", "_all", "counts", "_idf", "features"]
        return self.model.transform(df).withColumn("topic_vector", project(vector_to_array("features"))).drop(*helpers)

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession

        self.model.write().overwrite().save(f"{path}/features")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(i, row) for i, row in enumerate(self.basis)], "i int, row array<double>").write.mode("overwrite").parquet(f"{path}/basis")

    @classmethod
    def load(cls, path: str) -> Lsa:
        from pyspark.sql import SparkSession

        rows = SparkSession.getActiveSession().read.parquet(f"{path}/basis").orderBy("i").collect()
        return cls(PipelineModel.load(f"{path}/features"), [r.row for r in rows])

    def search(self, items: DataFrame, id_col: str, query: str, k: int = 5, text: str = "text") -> DataFrame:
        """The k items nearest to a query text; ``items`` has ``topic_vector``."""
        spark = items.sparkSession
        asked = self.transform(spark.createDataFrame([(-1, query)], f"{id_col} bigint, {text} string"))
        return top_k(items, asked, id_col, "topic_vector", k, len(self.basis[0]))


def clusters(items: DataFrame, id_col: str, vector: str, k: int = 12, seed: int = 0) -> DataFrame:
    """(id, cluster, vector, centre) by k-means on an array column."""
    rows = items.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), array_to_vector(vector).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=20).fit(rows)
    centres = items.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    return model.transform(rows).withColumnRenamed("prediction", "cluster").select("id", "cluster", "vector").join(F.broadcast(centres), "cluster")


def cluster_report(assigned: DataFrame, exemplars: int = 5) -> DataFrame:
    """(cluster, size, exemplars): ids nearest to each centre, ties by id."""
    gap = F.aggregate(F.zip_with("vector", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    near = assigned.select("cluster", "id", gap.alias("gap")).withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy("gap", "id"))).filter(F.col("r") <= exemplars)
    names = near.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda s: s.id.cast("string")), ",").alias("exemplars"))
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).join(names, "cluster")


def hashed_encoding(df: DataFrame, text: str, dim: int = 256) -> DataFrame:
    """``df`` with ``embedding``: unit-length hashed word counts, where no trained encoder is at hand."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[^\p{L}\p{N}_]+")
    out = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim).transform(tok.transform(df.fillna("", [text])))
    return Normalizer(inputCol="_tf", outputCol="_unit").transform(out).withColumn("embedding", vector_to_array("_unit", "float32")).drop("_tok", "_tf", "_unit")
