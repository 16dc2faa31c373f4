"""Report outputs in byte ranges, samples, damaged zips and audit facts of odd documents."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from bindery.operators import audit, documents, volumes


def test_reports_are_the_same_in_one_split_and_in_fifty(spark, tmp_path):
    block = lambda i: f'<repInfo uri="f{i}">\n <status>ok é</status>\n<messages><message severity="error">e{i}</message></messages>{"<x/>" * (i % 40)}\n</repInfo>\n'
    text = '<?xml version="1.0"?>\n<jhove>\n<date>x</date>\n' + "".join(block(i) for i in range(400)) + '<repInfo uri="bad"><status></repInfo>\n</jhove>\n'
    (tmp_path / "report.xml").write_text(text)
    found, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (len(text.encode()) + 1, len(text.encode()) // 50):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            reports = volumes.read_reports(spark, str(tmp_path))
            found.append((reports.rdd.getNumPartitions(), sorted(map(tuple, reports.select("uri", "status", F.concat_ws(",", "errors"), "xml").collect()))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (few, one), (many, fifty) = found
    assert few < many and many >= 40 and one == fifty and len(one) == 401
    assert [(u, s, e) for u, s, e, _ in one if u == "f7"] == [("f7", "ok é", "e7")]
    assert [(u, s) for u, s, *_ in one if u == "bad"] == [("bad", None)]


def test_outcomes_of_missing_doubled_and_stray_reports(spark):
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "uri string")
    reports = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("b", "ok"), ("d", None), ("z", "ok")], "uri string, status string")
    assert {r["uri"]: r["outcome"] for r in volumes.report_outcomes(asked, reports).collect()} == {"a": "ok", "b": "BadField", "c": "MissingFile", "d": "BadFile", "z": "Unexpected"}


def test_a_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, 1).alias("deleted"), F.lit("x").alias("saved_md5sum"), F.when(F.col("id") % 3 == 0, "now").alias("restore_request"))
    picks = [[r["id"] for r in audit.sample(rows.repartition(n), 5, ["id"], 20).collect()] for n in (1, 7)]
    assert picks[0] == picks[1] and len(set(picks[0])) == 20 and all(i % 2 and i % 3 for i in picks[0])
    assert picks[0] != [r["id"] for r in audit.sample(rows, 6, ["id"], 20).collect()] and audit.sample(rows.limit(0), 5, ["id"]).count() == 0


def test_a_member_damaged_inside_is_told(spark):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.txt", b"text " * 1000)
    raw = bytearray(held.getvalue())
    raw[45:60] = b"\xff" * 15
    rows = spark.createDataFrame([("a", bytes(raw)), ("b", held.getvalue()), ("c", None)], "volume string, content binary")
    assert {r["volume"]: r["file"] for r in volumes.zip_members(rows).collect()} == {"a": None, "b": "one.txt", "c": None}


def test_facts_of_odd_documents(spark):
    rows = spark.createDataFrame([("none", None), ("broken", "<mets>"), ("bare", "<mets/>"), ("a b", '<mets><fileSec><fileGrp USE="image"><file SIZE="5" CHECKSUM="' + "0" * 32 + '"><FLocat href="a+b.zip"/></file><file/></fileGrp></fileSec></mets>')], "volume string, xml string")
    found = {}
    for r in documents.repository_facts(rows).collect():
        found.setdefault(r["volume"], {})[r["kind"]] = (r["name"], r["n"])
    assert found["none"] == found["broken"] == {"METS_VALID": (None, 0)}
    assert found["bare"]["PAGES"] == (None, 0) and found["bare"]["PREMIS_VERSION"] == ("none", None) and "MISSING_METS_CHECKSUM" in found["bare"]
    assert found["a b"]["IMAGE_SIZE"] == (None, 5) and found["a b"]["ZIP_CHECKSUM"] == ("0" * 32, None) and found["a b"]["FILETYPE"] == ("zip", 1)


def test_facts_take_one_parse_and_no_python(spark, sf_dir):
    from bindery.plans import QUERIES

    plan = QUERIES["repository_facts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1 and "Python" not in plan


def test_times_have_at_most_one_offset(spark):
    from bindery.functions.checks import time_of

    forms = ["2024-01-02T03:04:05", "2024-01-02T03:04:05Z", " 2024-01-02T03:04:05-05:00 ", "2024-01-02T03:04:05+01:00Z", "2024-01-02T03:04:05+01:00+01:00", "2024-01-02T03:04", "2024-01-02 03:04:05", None]
    rows = spark.createDataFrame(list(enumerate(forms)), "i int, x string").select("i", time_of(F.col("x")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in rows] == ["2024-01-02T03:04:05"] * 3 + [None] * 5


def test_unpacking_skips_what_it_can_not_open_and_tells_what_is_damaged(spark):
    def packed(*members, method=zipfile.ZIP_STORED):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", method) as z:
            for name, data in members:
                z.writestr(name, data)
        return bytearray(held.getvalue())

    whole = packed(("in/A.TXT", "a"), ("in/", ""), ("é.XML", ""))
    method, damaged = packed(("a", "a"), ("B", "b")), packed(("a", "text" * 500), ("b", "b"))
    last = method.rindex(b"PK\x01\x02")
    method[last + 10 : last + 12] = b"\x63\x00"  # a method that nobody knows
    damaged[200] ^= 255
    rows = [("whole", bytes(whole)), ("twice", bytes(packed(("x/a", "1"), ("y/a", "2")))), ("method", bytes(method)), ("damaged", bytes(damaged)), ("none", None), ("text", b"no zip"), ("empty", bytes(packed()))]
    zips = spark.createDataFrame(rows, "volume string, content binary")
    found = sorted((r["volume"], r["file"] or "", r["size"], r["status"]) for r in volumes.unpacked(zips).collect())
    assert found == [("damaged", "a", None, "error"), ("damaged", "b", 1, "ok"), ("method", "a", 1, "ok"), ("method", "b", None, "warning"), ("none", "", None, "error"), ("text", "", None, "error"), ("twice", "a", 1, "ok"), ("twice", "a", 1, "ok"), ("whole", "a.txt", 1, "ok"), ("whole", "é.xml", 0, "ok")]
    kept = {r["file"] for r in volumes.unpacked(zips, keep_case=True).filter("volume = 'whole'").collect()}
    assert kept == {"A.TXT", "é.XML"}
    outcome = {r["volume"]: (r["status"], r["n"]) for r in volumes.unpack_outcomes(zips, volumes.unpacked(zips)).collect()}
    assert outcome == {"whole": ("ok", 2), "twice": ("ok", 2), "method": ("warning", 1), "damaged": ("error", 1), "none": ("error", 0), "text": ("error", 0), "empty": ("ok", 0)}


def test_members_go_on_before_the_batch_is_read():
    class Taken:
        select = lambda self, *columns: self
        mapInPandas = lambda self, f, schema: f

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("A.txt", "a")
    batch = pd.DataFrame({"volume": [str(i) for i in range(2500)], "content": [held.getvalue()] * 2500})
    frames = list(volumes.unpacked(Taken())(iter([batch])))
    assert sum(map(len, frames)) == 2500 and max(map(len, frames)) <= 1000
