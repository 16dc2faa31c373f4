"""The job stream: consumption, running counts, and the per-volume state machine."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.machine import RETRIES, STAGES
from ..operators.queueing import RELEASE_STATES
from ..sources.readers import messages, valid_message


def shared_folder(spark: SparkSession) -> str:
    """A folder for checkpoints and sinks that driver and executors share: under spark.checkpoint.dir where that is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="bindery-stream-")
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 8) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true")
    return reader.load(f"{sf_dir}/{name}.parque[t]")  # a source takes one file only by a pattern, which a folder matches as well


def accepted(stream: DataFrame, body: str = "body") -> DataFrame:
    """Messages that have all four fields, parsed; dead_letters() has the others."""
    return stream.filter(valid_message(F.col(body))).select("*", messages(F.col(body)).alias("job")).select("*", "job.*").drop("job")


def dead_letters(stream: DataFrame, body: str = "body") -> DataFrame:
    """Messages that no worker can take."""
    return stream.filter(~valid_message(F.col(body)))


def to_end(result: DataFrame, mode: str, into: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream over what there is; a batch that is run again overwrites its own output, so the sink is idempotent."""
    running = result.writeStream.outputMode(mode).foreachBatch(into).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()


def final_counts(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by keys when the stream has run to its end."""
    spark, folder = stream.sparkSession, shared_folder(stream.sparkSession)
    counts = stream.groupBy(*keys).agg(F.count("*").alias("n"))
    to_end(counts, "update", lambda df, batch: df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{folder}/out/{batch}"), f"{folder}/check")
    changes = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/out")
    return changes.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def moves() -> tuple[list[tuple[str, int]], np.ndarray]:
    """The (status, failures) that a volume can be in, the first a new volume's; and [success, state]: the state after an outcome.

    After a release the volume starts anew, so the states are few and fixed.
    """
    stages = {s: (good, bad) for s, _, good, bad in STAGES["ia"]}
    states, after = [("ready", 0)], []
    for status, failures in states:  # grows by what can be reached
        good, bad = stages.get(status, ("punted", "punted"))
        row = []
        for new in (("punted" if failures >= RETRIES else bad or "punted", failures + 1), (good, failures)):
            new = ("ready", 0) if new[0] in RELEASE_STATES else new
            if new not in states:
                states.append(new)
            row.append(states.index(new))
        after.append(row)
    return states, np.array(after, dtype=np.int32).T


def advanced(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partition of outcomes in order of (volume, event_id): each volume's run of them as the state that follows from every state."""
    part, (states, after) = TaskContext.get().partitionId(), moves()
    volume, goes, steps = None, None, 0
    row = lambda: pd.DataFrame({"volume": pd.array([volume], dtype="Int64"), "part": [part], "goes": [goes.tolist()], "steps": [steps]})
    for pdf in pdfs:
        volumes = pdf["volume"].astype("Int64")
        for v, ok in zip(volumes, pdf["success"].to_numpy(dtype=np.int64)):
            v = None if v is pd.NA else v
            if goes is None or v != volume:
                if goes is not None:
                    yield row()
                volume, goes, steps = v, np.arange(len(states), dtype=np.int32), 0
            goes = after[ok][goes]
            steps += 1
    if goes is not None:
        yield row()


def final_states(stream: DataFrame) -> DataFrame:
    """Each volume's state after a stream of (volume, event_id, success); event_id orders a volume's outcomes.

    They may come in any order and in any number of files, so the stream only
    collects them. At its end they are sorted over ranges of (volume, event_id): a
    volume with many outcomes is cut into several ranges, each of which gives one
    row, and these few rows are applied one after the other.
    """
    spark, folder = stream.sparkSession, shared_folder(stream.sparkSession)
    outcomes = stream.select(F.col("volume").cast("long").alias("volume"), "event_id", F.coalesce("success", F.lit(False)).alias("success"))
    to_end(outcomes, "append", lambda df, batch: df.write.mode("overwrite").parquet(f"{folder}/out/{batch}"), f"{folder}/check")
    order = ("volume", F.col("event_id").asc_nulls_last(), "success")
    came = spark.read.schema(outcomes.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/out")
    runs = came.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(advanced, "volume long, part int, goes array<int>, steps long")
    whole = runs.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("part", "goes"))).alias("runs"), F.sum("steps").alias("steps"))
    at = F.aggregate("runs", F.lit(0), lambda state, run: run["goes"][state])
    states = F.array(*(F.struct(F.lit(s).alias("status"), F.lit(n).cast("long").alias("failure_count")) for s, n in moves()[0]))
    return whole.select("volume", F.get(states, at).alias("s"), "steps").select("volume", "s.*", "steps")
