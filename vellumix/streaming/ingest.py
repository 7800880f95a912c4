"""Incremental ingest of document files into a catalogue.

A file-source stream takes a bounded number of files per micro-batch; each batch is profiled and
written under its batch id, so that a batch that is run again overwrites its own rows and nothing
else. Ids already in the catalogue are skipped and counted. Copies are decided across batches: the
hashed runs of words of all canonical rows are kept beside the catalogue, and a batch is compared with
those of the batches before it, whose rows come first; what was decided stays so. Rows with an unusable id or without text
go to the dead letters with a message. If a batch fails, its offset is not committed and the stream
stops: the next run starts with that batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumix.functions.text import error_signature
from vellumix.operators.analytics import capped_signatures
from vellumix.operators.dedup import decided_after, shingle_sets, unseen
from vellumix.plans.catalog import SHINGLE_WORDS, catalog_rows, cleaned, profiled
from vellumix.sources.readers import split_ids
from vellumix.sources.writers import _fs, _path
from vellumix.storage import written


@dataclass(frozen=True)
class Ingest:
    """Where the catalogue, its dead letters and the progress of the stream are kept."""

    root: str
    files_per_batch: int = 50
    least: float = 0.8

    @property
    def catalog(self) -> str:
        return f"{self.root}/catalog"

    @property
    def dead(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def counts(self) -> str:
        return f"{self.root}/counts"

    @property
    def sets(self) -> str:
        return f"{self.root}/canonical_sets"

    def _known(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        if not _fs(spark, self.catalog).exists(_path(spark, self.catalog)):
            return None
        return self._read(spark, self.catalog, "id bigint").filter(F.col("batch_id") < batch_id).select("id")

    @staticmethod
    def _read(spark: SparkSession, path: str, columns: str) -> DataFrame:
        """The named columns; a schema is given, as a table without rows has no file to take one from."""
        return spark.read.schema(columns + ", batch_id bigint").parquet(path)

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """Profile one micro-batch and write its rows, dead letters and counts."""
        spark = rows.sparkSession
        rows = written(rows, "batch")
        # the newest delivery of an id within a batch counts
        order = F.struct(*[F.col(c) for c in ("ingested_at",) if c in rows.columns], F.xxhash64("text"))
        good, bad = split_ids(rows.groupBy("id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "id"]), order).alias("r")).select("id", "r.*"))
        blank = good.filter("text IS NULL OR trim(text) = ''").withColumn("error", F.concat(F.lit("no text in row "), F.col("id")))
        good = good.filter("text IS NOT NULL AND trim(text) <> ''")
        known = self._known(spark, batch_id)
        new = unseen(good, known, "id") if known is not None else good
        once = lambda df, path: df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        texts = written(cleaned(new), "clean")
        sets = written(shingle_sets(texts, "id", "clean", SHINGLE_WORDS), "sets")
        old = None
        if _fs(spark, self.sets).exists(_path(spark, self.sets)):
            old = self._read(spark, self.sets, "id bigint, n int, c1 bigint, c2 bigint, set binary, hash string").filter(F.col("batch_id") < batch_id)
        choice = written(decided_after(sets, old, self.least), "choice")
        flags = choice.select("id", F.col("is_canonical").cast("int").alias("is_canonical"), "dup_of")
        once(catalog_rows(profiled(texts)).join(flags, "id"), self.catalog)
        once(sets.join(choice.filter("is_canonical").select("id"), "id", "left_semi"), self.sets)
        dead = bad.select(F.col("id").cast("string").alias("id"), "error").unionByName(blank.select(F.col("id").cast("string").alias("id"), "error"))
        once(dead, self.dead)
        seen = rows.agg(F.count(F.lit(1)).alias("rows_in"), F.count_distinct("id").alias("ids_in"))
        once(seen, self.counts)

    def run(self, spark: SparkSession, source: str, schema: str) -> DataFrame:
        """Take everything that is there now, then report."""
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(source)
        query = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.root}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
        return self.report(spark)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row: rows and ids taken, rows written, rows skipped as known, dead letters; fails if nothing was ever taken."""
        taken = spark.read.parquet(self.counts).agg(F.sum("rows_in").alias("rows_in"), F.sum("ids_in").alias("ids_in")).first()
        if not taken.rows_in:
            raise RuntimeError("the ingest took no rows")
        written_, dead = self._read(spark, self.catalog, "id bigint").count(), self._read(spark, self.dead, "id string").count()
        return spark.createDataFrame([(taken.rows_in, taken.ids_in, written_, taken.ids_in - written_ - dead, dead)], "rows_in bigint, ids_in bigint, rows_written bigint, ids_skipped bigint, dead_letters bigint")

    def unprocessed(self, spark: SparkSession, source: str, schema: str) -> DataFrame:
        """(id) of the source's rows that are neither in the catalogue nor among the dead letters."""
        done = self._read(spark, self.catalog, "id bigint").select(F.col("id").cast("string").alias("id")).unionByName(self._read(spark, self.dead, "id string").select("id"))
        known = F.coalesce(F.col("id").try_cast("bigint").cast("string"), F.col("id"))
        return unseen(spark.read.schema(schema).parquet(source).select(known.alias("id")).filter("id IS NOT NULL").distinct(), done, "id")

    def causes(self, spark: SparkSession, most: int = 100) -> DataFrame:
        """(signature, n) of the dead letters."""
        return capped_signatures(self._read(spark, self.dead, "id string, error string").withColumn("signature", error_signature(F.col("error"))), "signature", most)
