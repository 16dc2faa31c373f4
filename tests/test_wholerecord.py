"""Whole records: every part comes back, odd ones too, and faults are told."""

import datetime

from pyspark.sql import functions as F

from bindery.operators import wholerecord as w

MADE = datetime.datetime(2024, 1, 2, 3, 4, 5)
SECTION = "volume long, kind string, label string, mdtype string, content string, href string"
FILE = "volume long, use string, file string, file_id string, page long, size long, md5sum string, admid string"


def made(spark, volumes, sections=(), files=()):
    v = spark.createDataFrame([(i, MADE, "NEW") for i in volumes], "volume long, made timestamp, status string")
    return w.assembled(v, w.numbered(spark.createDataFrame(list(sections), SECTION)), spark.createDataFrame(list(files), FILE))


def test_all_parts_come_back(spark):
    sections = [(1, "techMD", "b & c", "OTHER", "<x/>", None), (1, "techMD", "a", "OTHER", None, 'u"<>&'), (1, "dmdSec", None, "MARC", "<r/>", None), (2**60, "rightsMD", "q", "X", "<y/>", None), (3, "techMD", "left out", "X", "<y/>", None)]
    files = [(1, "image", "a&b <1>.jp2", "IMG1", 1, None, "m", "TMD1 TMD2"), (1, "zip", "v.zip", "ZIP1", None, 2**60, None, None)]
    found = {tuple(r) for r in w.items(made(spark, [1, 2**60], sections, files)).withColumn("refs", F.array_join("refs", " ")).collect()}
    assert found == {
        (1, "record", "1", "", "NEW", None, "2024-01-02T03:04:05Z"), (2**60, "record", str(2**60), "", "NEW", None, "2024-01-02T03:04:05Z"),
        (1, "section", "TMD1", "", "a", "OTHER", None), (1, "section", "TMD2", "", "b & c", "OTHER", None), (1, "section", "DMD1", "", None, "MARC", None), (2**60, "section", "RMD1", "", "q", "X", None),
        (1, "file", "IMG1", "TMD1 TMD2", "a&b <1>.jp2", "m", None), (1, "file", "ZIP1", "", "v.zip", None, None), (1, "page", "1", "IMG1", None, None, None),
    }


def test_faults(spark):
    files = [(1, "image", "a", "I1", 1, 1, "m", "TMD9"), (1, "image", "b", "I1", 2, 1, "m", None), (2, "image", "a", "I1", 1, 1, "m", None)]
    documents = made(spark, [1, 2, 4], [], files).unionByName(spark.createDataFrame([(5, "<METS:mets"), (6, None)], "volume long, xml string"))
    found = {tuple(r) for r in w.record_faults(w.items(documents), []).collect()}
    assert found == {(1, "dangling", "TMD9"), (1, "duplicate", "I1"), (5, "broken", None), (6, "broken", None)}
    assert {tuple(r) for r in w.record_faults(w.items(documents), ["capture"]).filter("fault = 'missing event'").collect()} == {(i, "missing event", "capture") for i in (1, 2, 4)}
    assert w.record_faults(w.items(documents.limit(0)), ["capture"]).count() == 0


def test_one_parse_for_all_faults(spark):
    plan = w.record_faults(w.items(made(spark, [1])), ["capture"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1, plan.count("from_xml")


def test_source_events_take_each_id_once(spark):
    rows = "volume long, eventid string, eventtype string, date timestamp, detail string, agent string"
    captures = spark.createDataFrame([(1, "c", "capture", MADE, None, "x"), (1, "c", "capture", MADE, None, "x"), (1, "c", "capture", MADE.replace(year=2025), None, "x")], rows)
    volumes = spark.createDataFrame([(1, MADE), (2, MADE)], "volume long, made timestamp")
    found = w.source_events(volumes, captures, captures.limit(0)).collect()
    assert sorted((r["volume"], r["eventtype"]) for r in found) == sorted([(1, "capture"), *((v, e) for v in (1, 2) for e in w.OWN_EVENTS)])
    assert {r["date"] for r in found} == {MADE} and len({r["eventid"] for r in found}) == 7
