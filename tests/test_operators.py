"""Behaviours of the domain operators that the test tables do not hold."""

import io
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from bindery.functions import scalars as s
from bindery.operators import audit, machine, package, queueing
from bindery.sources import readers, sinks


def one(df):
    return df.collect()[0][0]


def value(spark, column):
    return one(spark.range(1).select(column))


@pytest.mark.parametrize("old, new, expected", [(0, 3, 0), (1, 1, 0), (3, 0, 2), (3, 3, 2), (1, 0, 0)])
def test_expiration_keeps_the_newest_old_version(spark, old, new, expected):
    versions = [f"2020010{i + 1}000000" for i in range(old)] + [f"2023120{i + 1}000000" for i in range(new)]
    df = spark.createDataFrame([("ns", "a", v, "versioned", "x", None) for v in versions], "namespace string, id string, version string, storage_name string, saved_md5sum string, deleted int")
    assert audit.expired(df, "versioned", "2024-01-01 00:00:00").count() == expected


def test_expiration_ignores_deleted_and_other_storages(spark):
    df = spark.createDataFrame([("ns", "a", "20200101000000", "versioned", "x", 1), ("ns", "a", "20200102000000", "versioned", "x", None), ("ns", "a", "20200103000000", "other", "x", None)], "namespace string, id string, version string, storage_name string, saved_md5sum string, deleted int")
    assert audit.expired(df, "versioned", "2024-01-01 00:00:00").count() == 0


@pytest.mark.parametrize("level, expected", [(1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c", "d"])])
def test_reset_levels(spark, level, expected):
    queue = spark.createDataFrame([("a", "punted", None), ("b", "collated", None), ("c", "ready", None), ("d", "punted", "node")], "id string, status string, node string").withColumns({"namespace": F.lit("ns"), "failure_count": F.lit(3).cast("long")})
    done = queueing.reset(queue, level).collect()
    assert sorted(r["id"] for r in done) == expected
    assert all(r["status"] == "ready" and r["failure_count"] == 0 for r in done)


def test_retry_limit_counts_failures_before_this_one(spark):
    rows = spark.createDataFrame([(i, False) for i in range(7)], "failures long, ok boolean")
    after = [r[0] for r in rows.orderBy("failures").select(machine.new_status(F.col("ok"), F.lit("downloaded"), F.lit("ready"), F.col("failures"))).collect()]
    assert after == ["ready"] * 5 + ["punted"] * 2


def test_stage_that_was_never_done_counts_as_failed(spark):
    assert value(spark, machine.new_status(F.lit(None).cast("boolean"), F.lit("packed"), F.lit(""), F.lit(0))) == "punted"


def test_null_priority_is_claimed_first(spark):
    queue = spark.createDataFrame([("a", 1), ("b", None)], "id string, priority int").withColumns({"namespace": F.lit("ns"), "status": F.lit("ready"), "reset_status": F.lit(None).cast("string"), "node": F.lit(None).cast("string"), "date_added": F.lit("2024")})
    assert one(queueing.claim(queue, "n", 1).select("id")) == "b"


def test_delivery_by_priority_then_arrival(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 3, "b"), (3, 3, "c"), (4, 2, "d")], "arrival int, priority int, id string")
    assert [r["id"] for r in queueing.delivery_order(df).collect()] == ["b", "c", "d", "a"]


def test_upsert_takes_nulls_of_the_new_row(spark):
    old = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "id string, x int, y int")
    new = spark.createDataFrame([("a", None), ("c", 9)], "id string, x int")
    assert sorted(map(tuple, sinks.upsert(old, new, ["id"]).collect())) == [("a", None, 5), ("b", 2, 6), ("c", 9, None)]


def test_checksum_file_edge_cases(spark):
    md5 = "0123456789ABCDEF0123456789abcdef"
    lines = [f"﻿{md5}  a.txt", f"{md5} *dir/B.TXT \r", "junk", f"{md5} Thumbs.db", f"{md5.replace('0', '1')}  a.txt", ""]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "volume int, line_no int, line string")
    assert sorted((r["file"], r["md5sum"]) for r in readers.checksum_lines(df).collect()) == [("a.txt", md5.replace("0", "1").lower()), ("b.txt", md5.lower())]


def test_utf8_and_control_characters(spark):
    df = spark.createDataFrame([(b"ok\t\n",), (b"bad\r",), (b"\xff",), (b"\x01",), ("é".encode(),)], "b binary")
    assert [r[0] for r in df.select(package.bytes_status(F.col("b"))).collect()] == ["ok", "BadUTF", "BadUTF", "BadUTF", "ok"]


def test_pairtree_round_trip_and_bad_escape(spark):
    assert value(spark, readers.pairtree_decode(readers.pairtree_encode(F.lit("ark:/13960/t1.x")))) == "ark:/13960/t1.x"
    assert value(spark, readers.pairtree_decode(F.lit("a^20b"))) == "a b"
    assert value(spark, readers.pairtree_decode(F.lit("a^zz"))) is None


def test_known_check_character_and_uuid(spark):
    assert value(spark, s.ark_valid(F.lit("ark:/13960/t7kq2zj36")))
    assert not value(spark, s.ark_valid(F.lit("ark:/13960/t7kq2zj37")))
    expected = str(uuid.uuid3(uuid.UUID(s.UUID_NAMESPACE), "ns-id-capture-2024"))
    assert value(spark, s.event_uuid(F.lit("ns"), F.lit("id"), F.lit("capture"), F.lit("2024"))) == expected


def test_messages_need_all_fields(spark):
    bodies = ['{"namespace":"a","id":"b","pkg_type":"c","status":"d"}', '{"namespace":"a","id":"0","pkg_type":"c","status":"d"}', "[1]", "no json", None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r[0] for r in df.select(readers.valid_message(F.col("body"))).collect()] == [True, False, False, False, False]


def test_yaml_and_zip_readers(spark):
    texts = spark.createDataFrame([(1, "capture_date: 2024:01:02 03:04:05\nn: 1"), (2, "a: [b"), (3, None)], "volume int, text string")
    found = {r["volume"]: (r["metadata"], r["error"]) for r in readers.yaml_metadata(texts.select(F.col("volume").cast("string"), "text")).collect()}
    assert found["1"][0]["capture_date"] == "2024-01-02T03:04:05" and found["2"][1] == "BadFile" and found["3"][1] == "MissingFile"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("v/IA_v.xml", "x")
    zips = spark.createDataFrame([("v", bytearray(data.getvalue())), ("w", bytearray(b"no"))], "volume string, content binary")
    assert {r["volume"]: r["status"] for r in readers.zip_source(zips).collect()} == {"v": "OK", "w": "CANT_UNZIP"}


def test_admin_handle_is_big_endian(spark):
    assert bytes(value(spark, sinks.admin_handle(F.lit(300), F.lit(4095), F.lit("0.na/x")))) == b"\x0f\xff\x00\x00\x00\x060.NA/X\x00\x00\x01\x2c\x00\x00"


def test_dead_letters_and_accepted_messages_part_the_stream(spark):
    from bindery.streaming.jobs import accepted, dead_letters

    df = spark.createDataFrame([('{"namespace":"a","id":"b","pkg_type":"c","status":"d"}',), ("no json",)], "body string")
    assert accepted(df).count() == 1 and dead_letters(df).count() == 1


def expected_states(outcomes):
    from bindery.operators.queueing import RELEASE_STATES

    stages, found = {a: (c, d) for a, _, c, d in machine.STAGES["ia"]}, {}
    for volume, _, ok in sorted(outcomes):
        status, failures, steps = found.get(volume, ("ready", 0, 0))
        good, bad = stages.get(status, ("punted", "punted"))
        status = good if ok else ("punted" if failures >= machine.RETRIES else bad or "punted")
        failures += not ok
        found[volume] = ("ready", 0, steps + 1) if status in RELEASE_STATES else (status, failures, steps + 1)
    return {(v, *x) for v, x in found.items()}


def test_machine_applies_outcomes_in_order_whatever_the_files_batches_and_frames(spark, tmp_path):
    from bindery.streaming import jobs

    # a third of the rows are one volume's; ids run against the order of the rows in files, over 12 files (two micro-batches) and frames of 50 rows
    outcomes = [((1 if i % 3 == 0 else 2 + i % 40), 3000 - i, (i * 7919 + i // 5) % 11 > 2) for i in range(3000)]
    df = spark.createDataFrame(outcomes, "volume long, event_id long, success boolean")
    df.repartition(12).write.parquet(f"{tmp_path}/events.parquet")
    df.limit(1).write.parquet(f"{tmp_path}/other.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(before, ("50", "false")):  # the large volume is also cut into several ranges
        spark.conf.set(k, v)
    try:
        found = {tuple(r) for r in jobs.final_states(jobs.table_stream(spark, str(tmp_path), "events")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == expected_states(outcomes)


def test_every_word_of_a_long_page_is_split(spark, tmp_path):
    from bindery.plans import QUERIES

    words = [[chr(97 + i % 26) * (1 + i // 26) for i in range(n)] for n in (0, 3, 15, 16, 21, 300)]
    spark.createDataFrame([(1, i, " ".join(w)) for i, w in enumerate(words)] + [(1, 6, None)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["page"]: r["text"] for r in QUERIES["ocr_split"](spark, str(tmp_path)).collect()}
    lines = [[" ".join(w[i : i + 5]) for i in range(0, len(w), 5)] for w in [*words, []]]
    assert found == {n + 1: "\n\n".join("\n".join(x[i : i + 2]) for i in range(0, len(x), 2)) for n, x in enumerate(lines)}


@pytest.mark.parametrize("name, table", [("marc_leaders", "orders"), ("filecount_rule", "orders"), ("rule_results", "lineitem"), ("rule_overrides", "lineitem"), ("cardinality_errors", "lineitem"), ("rule_errors", "lineitem")])
def test_queries_over_all_rows_leave_none_out(spark, sf_dir, name, table):
    from bindery.plans import QUERIES

    n, found = spark.read.parquet(f"{sf_dir}/{table}.parquet").count(), QUERIES[name](spark, sf_dir)
    if name == "filecount_rule":
        assert one(found.agg(F.sum("total"))) == n
    elif name == "marc_leaders":
        assert found.count() == n and one(found.agg(F.min(F.length("leader")))) == one(found.agg(F.max(F.length("leader")))) == 24
    elif name == "rule_errors":
        assert {"00000001.tif", "00000002.tif"} <= {r["file"] for r in found.select("file").distinct().collect()}
    else:
        rules = 1 if name == "cardinality_errors" else found.select("rule").distinct().count()
        assert found.count() == n * rules


def test_stages_of_ones_own_forced_outcomes_and_types(spark):
    from bindery.operators import lookups, machine, storage

    jobs = spark.createDataFrame([("simple", "a", "ready", 0), ("simple", "b", "inspected", 9), ("ia", "c", "ready", 0), ("none", "d", "ready", 0), (None, "e", None, 0)], "pkg_type string, id string, status string, failure_count long")
    own = [("simple", "ready", "Inspect", "inspected", "held"), ("simple", "inspected", "Again", "ready", "")]
    success = machine.outcome({"Inspect": F.lit(True), "Download": F.lit(None).cast("boolean")}, F.when(F.col("id") == "b", True))
    done = {r["id"]: (r["stage"], r["new_status"], r["new_failure_count"]) for r in machine.step(jobs, machine.transitions(spark, own), success).collect()}
    assert done == {"a": ("Inspect", "inspected", 0), "b": ("Again", "ready", 9), "c": ("Download", "ready", 1), "d": (None, "punted", 1), "e": (None, "punted", 1)}
    chains = {}
    for r in machine.ahead(jobs, own).orderBy("at").collect():
        chains.setdefault(r["id"], []).append(r["stage"])
    assert chains["a"] == ["Inspect", "Again"] and chains["b"] == ["Again", "Inspect"] and len(chains["c"]) == 12 and set(chains) == {"a", "b", "c"}
    typed = lookups.typed(jobs, {"x": F.lit("common")}, {"ia": {"x": F.lit("own"), "y": F.lit(1)}})
    assert {r["id"]: (r["x"], r["y"]) for r in typed.collect()} == {"a": ("common", None), "b": ("common", None), "c": ("own", 1), "d": ("common", None), "e": ("common", None)}
    backups = spark.createDataFrame([("n", "a", "v", "20240601000000")], "namespace string, id string, storage_name string, version string")
    deposits = spark.createDataFrame([("n", "a", 1), ("n", "a", 1), ("n", "b/123456", 2), ("n", "b/123456", 3), (None, "c", 4), ("n", None, 5)], "namespace string, id string, zip_size long").selectExpr("*", "1L as mets_size", "'m' as saved_md5sum")
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = storage.new_versions(backups, deposits, "v", F.lit("/b"), at).collect()
    assert [(r["id"], r["path"], r["zip_size"], r["md5check_ok"]) for r in rows] == [("b/123456", "/b/n/b=12/b=123456.20240601000000.zip", 3, 1)]
    assert storage.new_versions(backups, deposits, "v", F.lit("/b"), F.lit(None).cast("timestamp")).isEmpty()


def test_a_link_goes_before_the_configured_place(spark):
    from bindery.operators import storage

    deposits = spark.createDataFrame([("n", "a", "/new/a"), ("n", "b/c", "/new/b=c"), ("n", "d", "/new/d"), ("n", None, "/new/x")], "namespace string, id string, path string")
    links = spark.createDataFrame([("n", "a", "/old/2/a"), ("n", "a", "/old/1/a"), ("m", "d", "/old/d")], "namespace string, id string, target string")
    files = spark.createDataFrame([("/old/1/a/a.zip",), ("/old/1/a/a.mets.xml",), ("/new/b=c/b=c.zip",), ("/new/b=c/b=c.mets.xml",), ("/new/d/d.zip",), ("/new/d/other.mets.xml",), (None,)], "path string")
    found = {r["id"]: (r["path"], r["is_repeat"]) for r in storage.placements(deposits, links, files).collect()}
    assert found == {"a": ("/old/1/a", True), "b/c": ("/new/b=c", True), "d": ("/new/d", False), None: ("/new/x", False)}
