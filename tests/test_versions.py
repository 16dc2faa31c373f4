"""Versions of a table, and sinks that take each batch exactly once."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from bindery.sources.snapshots import Snapshots
from bindery.streaming import ledger


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_an_upsert_leaves_other_buckets_alone(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"), F.lit("x").alias("note"))
    table = Snapshots(spark, f"file://{tmp_path}/t", ["key"], buckets=16)
    assert table.create(rows) == 1 and table.read().count() == 2000
    before, old = files(f"{tmp_path}/t/data"), table.manifest()
    assert table.upsert(spark.createDataFrame([(5, None), (5000, 1)], "key long, value long")) == 2
    assert {f: t for f, t in files(f"{tmp_path}/t/data").items() if f in before} == before
    changed = {b for b, p in table.manifest().items() if old.get(b) != p}
    assert 1 <= len(changed) <= 2
    found = {r["key"]: (r["value"], r["note"]) for r in table.read().collect()}
    assert found[5] == (None, "x") and found[5000] == (1, None) and found[6] == (12, "x") and len(found) == 2001
    assert table.read(1).count() == 2000 and table.read(1).filter("key = 5").first()["value"] == 10
    assert table.delete(spark.createDataFrame([(6,)], "key long")) == 3 and table.read().filter("key = 6").isEmpty()
    assert table.put_back(1) == 4 and table.read().filter("key = 5").first()["value"] == 10


def test_a_run_that_fails_leaves_the_version_before(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("key"), F.lit(1).cast("long").alias("value"))
    table = Snapshots(spark, f"file://{tmp_path}/t", ["key"], buckets=4)
    table.create(rows)
    with pytest.raises(Exception):
        table.upsert(rows.withColumn("value", F.when(F.col("key") == 50, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.lit(9).cast("long"))))
    assert table.versions() == [1] and table.read().filter("value <> 1").isEmpty()
    with pytest.raises(Exception):
        table.create(rows)
    empty = Snapshots(spark, f"file://{tmp_path}/e", ["key"])
    with pytest.raises(ValueError):
        empty.read()
    empty.create(rows.limit(0))
    assert empty.read().count() == 0


def test_a_stream_stopped_between_its_sinks_gives_every_row_once(spark, tmp_path):
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).write.parquet(f"{tmp_path}/in/{i}")
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    sinks = {"rows": lambda b: b, "sums": lambda b: b.agg(F.sum("id").alias("s"), F.count("*").alias("n")), "last": lambda b: b.agg(F.max("id").alias("m"))}
    folder, stops, calls = f"file://{tmp_path}/out", {("sums", 1), ("last", 2)}, collections.Counter()

    def between(name, batch):
        calls[name, batch] += 1
        if (name, batch) in stops:
            stops.remove((name, batch))
            raise RuntimeError("stopped")

    for _ in range(3):
        try:
            ledger.run(stream(), folder, sinks, between)
        except Exception:  # the stream's own, with the stop as its cause
            continue
    n = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in").count()
    assert not stops and calls["rows", 1] == 2
    assert sorted(r["id"] for r in ledger.taken(spark, folder, "rows").collect()) == list(range(n))
    total = ledger.taken(spark, folder, "sums").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    assert (total["s"], total["n"]) == (n * (n - 1) // 2, n)
