"""Several sinks of one stream, each of which takes every batch exactly once.

A batch goes to a folder of its own in each sink, by overwriting, and then to the
sink's ledger. A run that stops between two sinks starts with the same batch again:
sinks whose ledger has it leave it out, the others write it over whatever they had.
Readers take the batches that the ledger names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Shape = Callable[[DataFrame], DataFrame]


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def once(spark: SparkSession, folder: str, sinks: dict[str, Shape], between: Callable[[str, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch that gives each sink its shape of the batch; between is called before each sink."""

    def into(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for name, shape in sinks.items():
                if between:
                    between(name, number)
                if _exists(spark, f"{folder}/{name}/ledger/{number}/_SUCCESS"):
                    continue
                shape(held).write.mode("overwrite").parquet(f"{folder}/{name}/batch/{number}")
                spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}/ledger/{number}")
        finally:
            held.unpersist()

    return into


def taken(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All rows of a sink's batches that its ledger names."""
    done = sorted(r["batch"] for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/{name}/ledger").collect())  # one number a batch
    return spark.read.parquet(*(f"{folder}/{name}/batch/{n}" for n in done))


def run(stream: DataFrame, folder: str, sinks: dict[str, Shape], between: Callable[[str, int], None] | None = None) -> None:
    """Run a stream over what there is; called again after a stop, it goes on where it was."""
    writer = stream.writeStream.foreachBatch(once(stream.sparkSession, folder, sinks, between)).option("checkpointLocation", f"{folder}/check")
    writer.trigger(availableNow=True).start().awaitTermination()
