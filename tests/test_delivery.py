"""Priority lanes, and messages that are handed out again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bindery.streaming import delivery

SCHEMA = "message long, kind string, at timestamp"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def put(spark, folder, rows, name):
    """rows of (message, kind, seconds) as one more file of a lane."""
    timed = [(m, k, None if s is None else T0 + dt.timedelta(seconds=s)) for m, k, s in rows]
    spark.createDataFrame(timed, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def came(df):
    at = int(T0.timestamp()) * 1_000_000
    return [(r["message"], r["attempt"], (r["micros"] - at) / 1e6) for r in df.orderBy("micros", "message", "attempt").collect()]


def test_higher_levels_first_and_first_come_within_one(spark, tmp_path):
    put(spark, f"{tmp_path}/1", [(1, "queued", 0), (3, "queued", 2)], "a")
    put(spark, f"{tmp_path}/2", [(2, "queued", 1)], "a")
    put(spark, f"{tmp_path}/3", [(4, "queued", 3)], "a")
    stream = delivery.lanes(spark, {n: f"{tmp_path}/{n}" for n in (1, 2, 3)}, SCHEMA, {1: 1, 2: 1, 3: 1})
    folder = f"file://{tmp_path}/run"
    found = delivery.handed_out(stream, 100, "10 seconds", folder)
    assert [r["message"] for r in found.orderBy("batch", F.desc("priority"), "micros").collect()] == [4, 2, 1, 3]


def test_each_level_has_its_own_offset_and_pace(spark, tmp_path):
    for i in range(4):
        put(spark, f"{tmp_path}/1", [(10 + i, "queued", i)], i)
        put(spark, f"{tmp_path}/3", [(30 + i, "queued", i)], i)
    stream = lambda: delivery.lanes(spark, {n: f"{tmp_path}/{n}" for n in (1, 3)}, SCHEMA, {1: 1, 3: 4})
    folder = f"file://{tmp_path}/run"
    found = delivery.handed_out(stream(), 1000, "100 seconds", folder).groupBy("batch", "priority").count()
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1), (0, 3, 4), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    put(spark, f"{tmp_path}/1", [(14, "queued", 4)], "more")
    again = delivery.handed_out(stream(), 1000, "100 seconds", folder)
    assert again.count() == 9 and again.select("message").distinct().count() == 9
    last = open(sorted((tmp_path / "run/check/offsets").glob("[0-9]*"), key=lambda p: int(p.name))[-1]).read().splitlines()
    assert sum("logOffset" in line for line in last) == 2


def test_what_is_finished_or_rejected_does_not_come_again(spark, tmp_path):
    put(spark, f"{tmp_path}/1", [(1, "queued", 0), (1, "finished", 5), (2, "queued", 1), (2, "rejected", 1), (9, "queued", 500)], "a")
    stream = delivery.lanes(spark, {1: f"{tmp_path}/1"}, SCHEMA, {1: 1})
    assert came(delivery.handed_out(stream, 10, "10 seconds").filter("message < 9")) == [(1, 1, 0), (2, 1, 1)]


def test_what_is_not_finished_comes_again_by_timer_and_at_once_when_lost(spark, tmp_path):
    put(spark, f"{tmp_path}/1", [(1, "queued", 0), (2, "queued", 0)], 0)
    stream = lambda: delivery.lanes(spark, {1: f"{tmp_path}/1"}, SCHEMA, {1: 1})
    folder = f"file://{tmp_path}/run"
    assert came(delivery.handed_out(stream(), 60, "10 seconds", folder)) == [(1, 1, 0), (2, 1, 0)]
    # a run of its own later: the state is that of the checkpoint
    put(spark, f"{tmp_path}/1", [(2, "lost", 20), (1, "queued", 30), (9, "queued", 100)], 1)
    assert came(delivery.handed_out(stream(), 60, "10 seconds", folder)) == [(1, 1, 0), (2, 1, 0), (2, 2, 20), (1, 2, 60), (2, 3, 80), (9, 1, 100)]
    put(spark, f"{tmp_path}/1", [(1, "finished", 110), (2, "finished", 111), (9, "rejected", 112), (1, "queued", 400), (1, "finished", 401)], 2)
    put(spark, f"{tmp_path}/1", [(7, "finished", 900)], 3)
    found = came(delivery.handed_out(stream(), 60, "10 seconds", folder))
    assert found[6:] == [(1, 1, 400)]


def test_odd_signals_count_for_nothing(spark, tmp_path):
    big = 2**60 + 1
    put(spark, f"{tmp_path}/1", [(None, "queued", 0), (1, "queued", None), (1, "seen", 1), (1, None, 1), (1, "finished", 2), (1, "lost", 3), (big, "queued", 4), (big, "queued", 4)], 0)
    stream = delivery.lanes(spark, {1: f"{tmp_path}/1"}, SCHEMA, {1: 1})
    assert came(delivery.handed_out(stream, 60, "1 second")) == [(big, 1, 4)]
    (tmp_path / "none").mkdir()
    put(spark, f"{tmp_path}/none", [], 0)
    assert came(delivery.handed_out(delivery.lanes(spark, {1: f"{tmp_path}/none"}, SCHEMA, {1: 1}), 60, "1 second")) == []


@pytest.mark.parametrize("seed", range(1))
def test_deliveries_do_not_depend_on_how_the_signals_are_cut_into_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = sorted(((rng.randrange(6), rng.choice(delivery.KINDS), rng.randrange(600)) for _ in range(80)), key=lambda r: r[2])
    whole, parts = f"{tmp_path}/whole/1", f"{tmp_path}/parts/1"
    put(spark, whole, rows, 0)
    for i in range(0, 80, 16):
        put(spark, parts, rows[i : i + 16], i)
    one, many = (came(delivery.handed_out(delivery.lanes(spark, {1: p}, SCHEMA, {1: 1}), 50, "5 seconds")) for p in (whole, parts))
    assert one == many and len(one) > 20
