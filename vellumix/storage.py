"""Reading test tables and cutting lineage, in one place."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the directory ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name``, spread over the cores if it has fewer splits.

    Work on texts is bound by CPU, and a table of one split would be worked on by one task. A split has
    at most ``spark.sql.files.maxPartitionBytes``, so what is moved here is bounded by that for each core;
    larger tables have more splits than cores and are left as they are.
    """
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine (tests) a temporary folder is set instead;
    on a cluster that would lose data, so it is an error.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        set_dir = "file://" + tempfile.mkdtemp(prefix="vellumix-")
        spark.conf.set("spark.checkpoint.dir", set_dir)
    return set_dir.rstrip("/")


_WRITTEN: list[str] = []
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="vellumix-code-")) / "vellumix.zip"  # of the driver, which serves it
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder as Parquet and read it back.

    Cuts lineage without localCheckpoint: the files outlive any executor, and columns that a later
    step does not use are not read again. Results read these tables, so they stay until ``clear``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete the tables that ``written`` made in this process, once their results are stored; how many there were."""
    n = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
