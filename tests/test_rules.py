"""The rule language on the JVM: paths, narrowed steps, inner documents and malformed XML."""

import pytest
from pyspark.sql import functions as F

from bindery.operators import rules as r
from bindery.plans import QUERIES

PACKET = '<x:xmpmeta xmlns:x="urn:x"><RDF><Description><ImageWidth>{}</ImageWidth></Description></RDF></x:xmpmeta>'
LIBRARY = r.Library(
    contexts={"top": (None, "rep"), "part": ("top", "part[@kind=a]"), "named": ("top", "property[name=N]/values"), "xmp": (None, r.DESCRIPTION)},
    queries={("top", "width"): "width", ("top", "packet"): "packet", ("part", "size"): "@size", ("part", "note"): ("note", "old/note"), ("named", "value"): "value", ("xmp", "width"): "ImageWidth", ("top", "error"): "message[@severity=error]"},
    inner={"xmp": lambda read: read.values("top", "packet")},
)


def escaped(text):
    return text.replace("&", "&amp;").replace("<", "&lt;")


def read(spark, *documents):
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, x string").coalesce(1)
    return LIBRARY.read(rows, "x").orderBy("i").collect()


def test_names_are_counted_and_read(spark):
    one, none = read(
        spark,
        '<?xml version="1.0"?><a:rep xmlns:a="urn:a"><width> 5 </width><part kind="b" size="9"/><part kind="a" size="3"><old><note>n1</note></old><note>n2</note></part>'
        "<property><name>M</name><values><value>1</value></values></property><property><name>N</name><values><value>2</value><value>3</value></values></property>"
        '<message severity="error">bad</message><message severity="info">good</message></a:rep>',
        "<rep/>",
    )
    assert (one["n:top"], one["v:top.width"], one["n:part"], one["v:part.size"]) == (1, " 5 ", 1, "3")
    assert (one["n:part.note"], one["v:part.note"]) == (2, "n2")  # the paths of a name in their order
    assert (one["n:named.value"], one["v:named.value"], one["n:top.error"], one["v:top.error"]) == (2, "2", 1, "bad")
    assert (none["n:top"], none["n:part"], none["n:top.width"], none["p:xmp"]) == (1, 0, 0, 0) and none["read:"]


@pytest.mark.parametrize("text", [None, "", "  ", "text", "<rep>", "<rep></repp>", "<rep/> and more", "<rep>&no;</rep>", "<rep a=1/>"])
def test_malformed_documents_are_told(spark, text):
    assert not read(spark, text)[0]["read:"]


def test_two_roots_are_two_contexts(spark):
    assert read(spark, "<rep/><rep/>")[0]["n:top"] == 2


def test_inner_documents(spark):
    inside = lambda *texts: "<rep><width>7</width>" + "".join(f"<packet>{escaped(t)}</packet>" for t in texts) + "</rep>"
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([inside(), inside(PACKET.format(7)), inside(PACKET.format(8)), inside("<x:xmpmeta>"), inside(PACKET.format(7), PACKET.format(7)), inside(PACKET.format("<ImageWidth/>"))])], "i int, x string")
    rule = r.v_if_packet("xmp", r.v_same("top", "width", "xmp", "width"))
    found = {x["i"]: [e["code"] for e in x["e"]] for x in LIBRARY.read(rows, "x").select("i", rule.alias("e")).collect()}
    assert found == {0: [], 1: [], 2: ["NotEqualValues"], 3: ["BadField"], 4: ["BadField"], 5: ["NotEqualValues"]}


def test_resolutions(spark):
    mix = lambda x, y, d="": f"<m><x><n>{x}</n>{d}</x><y><n>{y}</n></y></m>"
    library = r.Library(contexts={"mix": (None, "m")}, queries={("mix", "xRes_numerator"): "x/n", ("mix", "xRes_denominator"): "x/d", ("mix", "yRes_numerator"): "y/n", ("mix", "yRes_denominator"): "y/d"})
    rows = spark.createDataFrame([(0, mix(600, 600)), (1, mix(1200, 600, "<d>2</d>")), (2, mix(600, 300)), (3, mix(300, 300)), (4, mix("x", "x")), (5, "<m/>"), (6, mix(600, 600, "<d>0</d>"))], "i int, x string")
    found = {x["i"]: ([e["code"] for e in x["a"]], [e["code"] for e in x["b"]]) for x in library.read(rows, "x").select("i", r.v_resolution([600]).alias("a"), r.v_resolution_ge(300).alias("b")).collect()}
    wrong, missing = ["NotEqualValues"], ["MissingField", "MissingField"]
    assert found == {0: ([], []), 1: ([], []), 2: (wrong, wrong), 3: (["BadValue"], []), 4: (wrong, wrong), 5: (missing, missing), 6: (wrong, wrong)}


@pytest.mark.parametrize("name", ["rule_results", "rule_errors", "rule_overrides", "cardinality_errors", "tiff_report_rules", "jp2_report_rules", "xmp_agreement"])
def test_rules_stay_on_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("from_xml") <= 2


def test_columns_named_as_facts_are_kept_out(spark):
    rows = spark.createDataFrame([(1, "<rep><width>5</width></rep>", "mine")], "i int, x string, results string")
    done = r.check(rows, "x", LIBRARY, {"w": r.v_eq("top", "width", "5")})
    assert done.columns == ["i", "x", "results"] and done.select(F.size("results")).first()[0] == 1


def test_a_library_of_some_names_opens_no_other_element():
    asked = r.TIFF_REPORT.only(("tiffMeta", "xmp"), ("mix", "width"), ("xmp", "width"))
    assert list(asked.contexts) == ["repInfo", "tiffMeta", "mix", "xmp"] and list(asked.inner) == ["xmp"]
    ddl = asked.documents[""].ddl()
    assert "imageWidth" in ddl and "imageHeight" not in ddl and "Compression" not in ddl and ddl.count("_VALUE") == 1  # of value, which has the packet
    assert "ImageWidth" in asked.documents["xmp"].ddl() and "Artist" not in asked.documents["xmp"].ddl()


def test_texts_between_elements_that_nobody_asks_for_change_nothing(spark):
    a, b = read(spark, "﻿ \n<?xml version='1.0'?>\n<rep>loose<width>5</width>text<part kind='a' size='3'>more<note>n</note></part></rep>\n ", "<rep><width>5</width><part kind='a' size='3'><note>n</note></part></rep>")
    assert a.asDict() | {"i": 0, "x": ""} == b.asDict() | {"i": 0, "x": ""} and a["read:"] and a["n:part.note"] == 1


LISTED = r.Library(
    contexts={"top": (None, "rep"), "box": ("top", "box"), "in": (None, "x")},
    queries={("top", "version"): "version/value", ("top", "note"): "note", ("box", "id"): "id/value", ("box", "data"): "data/value", ("in", "y"): "y"},
    inner={"in": lambda read: F.transform(read.each("box", "data", "id", F.array(F.lit("1"), F.lit("-2"))), lambda v: F.array_join(F.transform(v, lambda c: F.char(c.cast("bigint"))), ""))},
    listed="value",
)
BYTES = "".join(f"<value>{b}</value>" for b in b"<x><y>" + b"long " * 200 + b"</y></x>")


@pytest.mark.parametrize(
    ("inside", "joined"),
    [
        (f"<version><value>0</value></version><box><id><value>1</value><value>-2</value></id><data>{BYTES}</data></box>", True),
        ("<version><value>0</value><value>1</value></version>", True),  # twice there, however it is read
        (f"<box><id><value>1</value>\n<value>-2</value></id><data>{BYTES}</data></box><!-- <value>1</value><value>2</value> -->", True),
        ("<version><value>a</value><value>1</value><value>2</value></version>", False),
        ("<version><value/>1</value><value>2</value></version>", False),
        ("<version><value></value><value>2</value></version>", False),
        ("<version><value><z/>1</value><value>2</value></version>", False),
        ('<note a="<value>1</value><value>2</value>"/>', True),
        ("<note><![CDATA[<value>1</value><value>2</value>]]></note>", False),
        ("<note>\x7f</note><version><value>1\x7f2</value></version>", False),
        ("<note>&#127;</note><version><value>1</value><value>2</value></version>", False),
    ],
)
def test_numbers_of_a_list_reach_the_parser_as_one_node(spark, inside, joined):
    rows = spark.createDataFrame([(1, f"<rep>{inside}</rep>")], "i int, x string")
    plain = r.Library(LISTED.contexts, LISTED.queries, LISTED.inner)
    assert LISTED.read(rows, "x").collect() == plain.read(rows, "x").collect()
    told = r._joined(rows, F.col("x"), "value").first()
    assert told["joined "] == joined and (told["text "] != told["x"]) == joined
    if joined and "data" in inside:
        assert told["text "].count("<value>") < 5 and LISTED.read(rows, "x").first()["v:in.y"] == "long " * 200


def test_attributes_are_made_only_where_some_are_asked_for(spark, monkeypatch):
    assert all(r._options(d).get("excludeAttribute") == "true" for library in (r.TIFF_REPORT, r.JP2_REPORT) for d in library.documents.values())
    assert "excludeAttribute" not in r._options(LIBRARY.documents[""]) | r._options(r.TIFF.documents[""])
    packet = escaped('<RDF a="1"><Description b="2"><ImageWidth c="3">7</ImageWidth><Make d="4"/></Description></RDF>')
    inside = f'<property><name e="5">XMP</name><values f="6"><value g="7">{packet}</value></values></property>'
    for name in ("IFD", "IFDs", "TIFFMetadata"):
        inside = f'<property h="8"><name>{name}</name><values i="9">{inside}</values></property>'
    rows = spark.createDataFrame([(1, f'<jhove><repInfo uri="x"><status j="1">ok</status><status k="2"/><format l="3"/><properties>{inside}</properties></repInfo></jhove>')], "i int, x string")
    found = r.TIFF_REPORT.read(rows, "x").first()
    assert (found["v:xmp.width"], found["n:xmp.make"], found["n:repInfo.status"], found["v:repInfo.status"]) == ("7", 1, 2, "ok")
    monkeypatch.setattr(r, "_options", lambda _: r.XML)
    assert r.TIFF_REPORT.read(rows, "x").first() == found
