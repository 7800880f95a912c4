"""TF-IDF over words and word pairs, relational from end to end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumix.functions.text import let, text_or_empty
from vellumix.storage import written

VOCABULARY = 1024


def terms(c: Column) -> Column:
    """Words of three or more letters a-z standing alone, then adjacent pairs of them joined by _."""
    runs = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))

    def with_pairs(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit("_"), b))
        return F.concat(w, F.filter(pairs, lambda x: x.isNotNull()))

    return let(F.filter(runs, lambda x: x.rlike("^[a-z]{3,}$")), with_pairs)


def vocabulary(df: DataFrame, text: str, most: int = VOCABULARY, least_docs: int = 1) -> DataFrame:
    """(term, df, idx, idf) of the most frequent terms by documents, ties by term."""
    n = df.count()
    # the outer form, as the inner one would compute the array a second time to filter empty ones
    each = df.select(F.explode_outer(F.array_distinct(terms(F.col(text)))).alias("term")).filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    top = each.filter(F.col("df") >= least_docs).orderBy(F.desc("df"), "term").limit(most)
    idx = F.row_number().over(Window.orderBy(F.desc("df"), "term")) - 1  # over at most ``most`` rows
    return top.withColumn("idx", idx).withColumn("idf", F.log((n + 1.0) / (F.col("df") + 1.0)) + 1.0)


def weights(df: DataFrame, id_col: str, text: str, vocab: DataFrame) -> DataFrame:
    """(id, idx, term, w): unit-length TF-IDF weights to 6 digits; tf counts all terms of a text."""
    tok = df.select(F.col(id_col).alias("id"), terms(F.col(text)).alias("t")).select("id", F.size("t").alias("n"), F.explode_outer("t").alias("term")).filter("term IS NOT NULL")
    tf = tok.groupBy("id", "n", "term").agg(F.count(F.lit(1)).alias("c"))
    raw = tf.join(F.broadcast(vocab.select("term", "idx", "idf")), "term").withColumn("w", F.col("c") / F.col("n") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.withColumn("w", F.round(F.col("w") / norm, 6)).select("id", "idx", "term", "w")


class Index:
    """A fitted TF-IDF index over a frame of items."""

    def __init__(self, items: DataFrame, id_col: str, text: str, title: str | None = None, most: int = VOCABULARY):
        self.items, self.id_col, self.title = items, id_col, title
        body = F.concat_ws(" ", text_or_empty(F.col(title)), text_or_empty(F.col(text))) if title else text_or_empty(F.col(text))
        docs = items.select(F.col(id_col).alias("id"), body.alias("text"))
        self.vocab = written(vocabulary(docs, "text", most), "vocab")
        self.weights = written(weights(docs, "id", "text", self.vocab), "weights")

    def save(self, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")

    @classmethod
    def load(cls, items: DataFrame, id_col: str, path: str, title: str | None = None) -> Index:
        spark, self = items.sparkSession, cls.__new__(cls)
        self.items, self.id_col, self.title = items, id_col, title
        self.vocab, self.weights = spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/weights")
        return self

    def _ranked(self, query: DataFrame, k: int) -> DataFrame:
        sims = self.weights.join(F.broadcast(query.select("idx", F.col("w").alias("q"))), "idx").groupBy("id").agg(F.sum(F.col("w") * F.col("q")).alias("s"))
        sims = sims.select("id", F.round(F.least(F.lit(1.0), F.col("s")), 4).alias("similarity"), "s")
        return sims.orderBy(F.desc("similarity"), "id").limit(k).select("id", "similarity")

    def search(self, query: str, k: int = 5) -> DataFrame:
        """(id, similarity) of the items most similar to a text; titles that contain it if it has no known term."""
        spark = self.items.sparkSession
        q = weights(spark.createDataFrame([(0, query)], "id int, text string"), "id", "text", self.vocab)
        rows = q.collect()  # the terms of one query
        if rows:
            return self._ranked(spark.createDataFrame([(r.idx, r.w) for r in rows], "idx int, w double"), k)
        hit = F.contains(F.lower(text_or_empty(F.col(self.title))), F.lit(query.lower())) if self.title else F.lit(False)
        return self.items.select(F.col(self.id_col).alias("id"), F.when(hit, 1.0).otherwise(0.0).alias("similarity")).orderBy(F.desc("similarity"), "id").limit(k)

    def similar(self, ident: int, k: int = 5) -> DataFrame:
        """(id, similarity) of the items most similar to one of them, itself excluded."""
        one = self.weights.filter(F.col("id") == ident)
        rest = Index.__new__(Index)
        rest.weights = self.weights.filter(F.col("id") != ident)
        return rest._ranked(one, k)
