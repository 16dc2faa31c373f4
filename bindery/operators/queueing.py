"""The work queue: gates, claims, resets, transitions and look-ups over snapshots of its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Statuses at which a volume leaves the queue's workers.
RELEASE_STATES = ("available", "in_process", "punted", "done", "collated", "rights", "held", "uplift_done", "migrated", "metadata_unpacked", "needs_metadata")
#: Message priorities; two names share one.
PRIORITY_HIGH, PRIORITY_MED, PRIORITY_LOW = 3, 2, 2
KEY = ["namespace", "id"]


def claimable() -> Column:
    return F.col("node").isNull() & ~F.col("status").isin(*RELEASE_STATES)


def top(df: DataFrame, n: int, *order: Column, within: tuple[str, ...] = ()) -> DataFrame:
    """The first n rows, of each group in `within`. Without groups Spark keeps n rows a task and merges those."""
    if not within:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("_at") <= n).drop("_at")


def claim(queue: DataFrame, node: str, n: int) -> DataFrame:
    """The first n claimable rows by priority, age and id, locked for a node; a null priority comes first."""
    first = top(queue.filter(claimable()), n, F.col("priority").asc_nulls_first(), F.col("date_added"), F.col("namespace"), F.col("id"))
    return first.withColumn("reset_status", F.col("status")).withColumn("node", F.lit(node))


def resettable(level: int) -> Column:
    """Level 1: punted; 2: any finished state as well; both only where unlocked. Level 3: every row."""
    if level == 3:
        return F.lit(True)
    states = ("punted",) if level == 1 else ("punted", "collated", "rights", "done")
    return F.col("node").isNull() & F.col("status").isin(*states)


def reset(queue: DataFrame, level: int, status: str = "ready") -> DataFrame:
    """The rows that a reset changes, as it leaves them."""
    return queue.filter(resettable(level)).withColumns({"status": F.lit(status), "failure_count": F.lit(0).cast("long"), "node": F.lit(None).cast("string")})


def enqueue_gate(items: DataFrame, zephir: DataFrame, disallow: DataFrame, queue: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Each item's outcome: no bibliographic data, then on the disallow list, then already there, else added.

    An item that is ignored as already there still counts as passed, so that its
    bibliographic row is marked as returned; only an added one sends a message.
    """
    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys).distinct().withColumn(name, F.lit(True))

    marked = items.join(flag(zephir, "_bib"), keys, "left").join(flag(disallow, "_no"), keys, "left").join(flag(queue, "_there"), keys, "left")
    outcome = F.when(F.col("_bib").isNull(), "NoBibData").when(F.col("_no"), "Disallowed").when(F.col("_there"), "ignored").otherwise("added")
    return marked.withColumn("outcome", outcome).withColumns({"mark_returned": outcome.isin("ignored", "added"), "send_message": outcome == "added"}).drop("_bib", "_no", "_there")


def update_queue(queue: DataFrame, results: DataFrame) -> DataFrame:
    """The queue after results (key, new_status, fail): the count rises on failure, the lock goes on a release state."""
    joined = queue.join(results.select(*KEY, "new_status", "fail"), KEY, "left")
    hit = F.col("new_status").isNotNull()
    return joined.withColumns({
        "status": F.coalesce("new_status", "status"),
        "failure_count": F.col("failure_count") + F.when(hit & F.col("fail"), 1).otherwise(0),
        "node": F.when(~(hit & F.col("new_status").isin(*RELEASE_STATES)), F.col("node")),
    }).select(*queue.columns)


def release_in_flight(queue: DataFrame, node: str) -> DataFrame:
    """A node's unfinished rows return to the status that they were claimed at."""
    held = (F.col("node") == node) & ~F.col("status").isin(*RELEASE_STATES)
    return queue.filter(held).withColumns({"status": F.coalesce("reset_status", "status"), "node": F.lit(None).cast("string")})


def locks(queue: DataFrame) -> DataFrame:
    return queue.filter("node is not null").groupBy("node").agg(F.count("*").alias("locks"))


def top_up(queue: DataFrame, node: str, limit: int) -> DataFrame:
    """A node's next claims, as many as it has free places; the count of its locks is one number."""
    held = queue.filter(F.col("node") == node).count()
    return claim(queue, node, max(0, limit - held))


def mark_returned(zephir: DataFrame, outcomes: DataFrame, keys: list[str] = KEY) -> DataFrame:
    hit = outcomes.filter("mark_returned").select(*keys).distinct().withColumn("_hit", F.lit(1))
    return zephir.join(hit, keys, "left").withColumn("returned", F.coalesce("_hit", "returned")).drop("_hit")


def messages(outcomes: DataFrame) -> DataFrame:
    """JSON bodies and priorities of the messages to send; a release state sends none."""
    sent = outcomes.filter(~F.col("status").isin(*RELEASE_STATES))
    return sent.select(F.to_json(F.struct("namespace", "id", "pkg_type", "status")).alias("body"), F.coalesce("priority", F.lit(PRIORITY_MED)).alias("priority"))


def last_errors(log: DataFrame) -> DataFrame:
    """The latest error of each volume."""
    latest = Window.partitionBy(*KEY).orderBy(F.desc("logged_at"), F.desc("event_id"))
    return log.filter("level = 'ERROR'").withColumn("_at", F.row_number().over(latest)).filter("_at = 1").drop("_at")


def delivery_order(queued: DataFrame) -> DataFrame:
    """The order within a micro-batch: higher priority first, then first come."""
    return queued.orderBy(F.desc("priority"), "arrival")


def delivery_places(queued: DataFrame, batch: str) -> DataFrame:
    """queued with each message's place in the delivery of its micro-batch."""
    order = Window.partitionBy(batch).orderBy(F.desc("priority"), "arrival")
    return queued.withColumn("place", F.row_number().over(order))
