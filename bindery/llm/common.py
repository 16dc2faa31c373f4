"""Helpers shared by the corpus operators: table access and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

#: Rows of a few numbers that one task of a small table takes.
ROWS_A_TASK = 50_000
#: What separates words wherever a contract says `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it.

    It is taken from spark.checkpoint.dir; only where that is unset and the
    master is local, as in tests, a temporary folder of this machine takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="bindery-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again.

    That cuts the lineage at a copy which survives lost executors. Where it has
    about `rows` rows, and these fit few tasks, no more tasks write it.
    """
    spark = df.sparkSession
    if rows is not None and (tasks := 1 + rows // ROWS_A_TASK) < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(tasks)
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that written() made and nothing needs any more."""
    spark = df.sparkSession
    root = shared_folder(spark).split("://")[-1]
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if root in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
