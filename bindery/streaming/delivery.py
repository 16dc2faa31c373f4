"""Messages in lanes by priority, handed out again until somebody finishes them.

A message is known by its key. The signals of a key, in order of their time, are
`queued` (handed out, unless it still is), `lost` (its taker went away: handed out
again at once), `finished` and `rejected` (gone, and not handed out again). A message
that nobody has finished when `patience` has passed since it was last handed out is
handed out again. Signals of one moment count in the order above; an unknown kind
counts for nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .jobs import shared_folder, to_end

KINDS = ("queued", "lost", "finished", "rejected")
OUT = "message long, priority int, attempt int, micros long"
STATE = "priority int, attempt int, last long"


def lanes(spark: SparkSession, folders: dict[int, str], schema: str, files: dict[int, int]) -> DataFrame:
    """The Parquet files of one folder a level as a stream with their priority.

    Every level is a source of its own and so has its own offset in the checkpoint; a
    batch takes files[level] files of it, more of the urgent ones, and no level waits
    until the others are empty.
    """
    read = lambda level: spark.readStream.schema(schema).option("maxFilesPerTrigger", files[level]).option("recursiveFileLookup", "true").parquet(folders[level])
    return reduce(DataFrame.unionAll, (read(level).withColumn("priority", F.lit(level)) for level in sorted(folders, reverse=True)))


def _turns(signals: Iterable[tuple[int, int, int]], held: tuple[int, int, int] | None, until: int, patience: int) -> tuple[list[tuple[int, int, int]], tuple[int, int, int] | None]:
    """(priority, attempt, time) of what is handed out up to a time, and what is held then, from ordered (time, kind, priority)."""
    out = []

    def hand(priority: int, attempt: int, at: int) -> tuple[int, int, int]:
        out.append((priority, attempt, at))
        return out[-1]

    def overdue(now: int) -> tuple[int, int, int] | None:
        again = held
        while again and again[2] + patience < now:
            again = hand(again[0], again[1] + 1, again[2] + patience)
        return again

    for at, kind, priority in signals:
        held = overdue(at)
        if kind == 0 and not held:
            held = hand(priority, 1, at)
        elif kind == 1 and held:
            held = hand(held[0], held[1] + 1, at)
        elif kind > 1:
            held = None
    held = overdue(until)
    return out, held


def deliveries(signals: DataFrame, patience: int, late: str) -> DataFrame:
    """(message, priority, attempt, micros) for each time that a message is handed out.

    signals has message (long), kind, priority and at (timestamp); patience is in
    seconds. Time is that of the signals: a message is overdue once the stream has
    seen a signal `late` after its time, and a signal that comes later than that does
    not count, as in any stream with a watermark. A null message or time counts for
    nothing, a null priority is 0; equal signals are one. The state is three numbers a
    message that is out; of a batch's signals a task holds the distinct ones of one
    message.
    """
    step = patience * 1_000_000

    def advance(key: tuple[int], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        found: set[tuple[int, int, int]] = set()
        if not state.hasTimedOut:
            for pdf in frames:
                found.update(zip(pdf["micros"].tolist(), pdf["rank"].tolist(), (-pdf["priority"]).tolist()))
        watermark = state.getCurrentWatermarkMs()
        ordered = [(at, rank, -minus) for at, rank, minus in sorted(found)]  # of several priorities the highest
        out, held = _turns(ordered, state.get if state.exists else None, watermark * 1000, step)
        if held:
            state.update(held)
            state.setTimeoutTimestamp((held[2] + step) // 1000)
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["priority", "attempt", "micros"]).assign(message=key[0])[["message", "priority", "attempt", "micros"]]

    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    known = signals.filter(F.col("message").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin(*KINDS))
    timed = known.withWatermark("at", late).select(F.col("message").cast("long").alias("message"), "at", F.unix_micros("at").alias("micros"), rank.alias("rank"), F.coalesce(F.col("priority").cast("int"), F.lit(0)).alias("priority"))
    return timed.groupBy("message").applyInPandasWithState(advance, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def handed_out(signals: DataFrame, patience: int, late: str, folder: str | None = None) -> DataFrame:
    """deliveries() of a stream up to what there is, each with its batch; with the same folder again it goes on from there.

    Each batch is written in its order of delivery, higher priority first and then by time.
    """
    spark = signals.sparkSession
    folder = folder or shared_folder(spark)

    def into(batch: DataFrame, number: int) -> None:
        batch.orderBy(F.desc("priority"), "micros", "message").write.mode("overwrite").parquet(f"{folder}/out/{number}")

    to_end(deliveries(signals, patience, late), "append", into, f"{folder}/check")
    came = spark.read.schema(OUT).option("recursiveFileLookup", "true").parquet(f"{folder}/out")
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/out/(\d+)/", 1).cast("long")
    return came.select("*", batch.alias("batch"))
