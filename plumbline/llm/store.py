"""Tables in the folder that driver and executors share, to cut lineage and to keep what several steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset and Spark runs in one process, a temporary folder is named once and kept in the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """df, written once as Parquet to the shared folder and read again. The files outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plumbline/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._plumbline_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes a table of materialize() that no plan still needs."""
    path = getattr(df, "_plumbline_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def join_skewed(rows: DataFrame, lookup: DataFrame, on: list[str], share: int = 10_000) -> DataFrame:
    """rows joined to lookup, which has one row for each key. Keys that hold over one in `share` of the rows, so `share` keys at most, are joined by a broadcast, the others by key; rows without a match, or with a null key, go.

    rows is read three times, so it should be a table.
    """
    often = rows.groupBy(*on).agg(F.count("*").alias("__n")).where(F.col("__n") > rows.count() / share).select(*on)
    hot = lookup.join(F.broadcast(often), on, "left_semi")
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(F.broadcast(often), on, "left_anti").join(lookup, on))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Arrow batches of bounded rows and bytes, so that a worker holds little text at once however long single texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
