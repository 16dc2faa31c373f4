"""One METS record from all its tables, read back into them from one parse, with its references checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .documents import NAMESPACES, attribute, structure
from .metadata import event_xml, mets_header

#: Kinds of metadata sections in the order of a record, and the beginning of their ids.
KINDS = {"dmdSec": "DMD", "techMD": "TMD", "rightsMD": "RMD", "sourceMD": "SMD", "digiprovMD": "DPMD"}
#: What a source record itself tells of its making, before the capture and the events that are asked for.
OWN_EVENTS = ("source metadata creation", "page md5 creation", "metadata validation")

PREMIS_EVENT = "struct<eventIdentifier:struct<eventIdentifierValue:string>,eventType:string,eventDateTime:string,eventDetail:string,linkingAgentIdentifier:struct<linkingAgentIdentifierValue:string>>"
ABOUT = "_MDTYPE:string,_LABEL:string"
SECTION = f"struct<_ID:string,mdWrap:struct<{ABOUT},xmlData:struct<premis:struct<event:array<{PREMIS_EVENT}>>>>,mdRef:struct<{ABOUT},_href:string>>"
FILE = "struct<_ID:string,_ADMID:string,_SIZE:bigint,_CHECKSUM:string,FLocat:struct<_href:string>>"
RECORD = f"""_OBJID string, metsHdr struct<_CREATEDATE:string,_RECORDSTATUS:string>, dmdSec array<{SECTION}>, amdSec struct<{','.join(f'{k}:array<{SECTION}>' for k in list(KINDS)[1:])}>,
  fileSec struct<fileGrp:array<struct<_USE:string,file:array<{FILE}>>>>, structMap struct<div:array<struct<_ORDER:bigint,_LABEL:string,fptr:array<struct<_FILEID:string>>>>>"""


def numbered(sections: DataFrame) -> DataFrame:
    """sections (volume, kind, label, mdtype, content or href) with section_id: the kind's beginning and a running number in the volume, by label."""
    prefix = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))[F.col("kind")]
    order = Window.partitionBy("volume", "kind").orderBy("label", "mdtype", "content", "href")
    return sections.withColumn("section_id", F.concat(prefix, F.row_number().over(order).cast("string")))


def present(volumes: DataFrame, labels: dict[str, str], kind: str = "techMD", mdtype: str = "OTHER") -> DataFrame:
    """Sections for those of several columns of volumes, each the text of a document, that are not null; labels by column."""
    each = F.array(*(F.struct(F.lit(label).alias("label"), F.col(c).alias("content")) for c, label in labels.items()))
    one = volumes.select("volume", F.inline(F.filter(each, lambda s: s["content"].isNotNull())))
    return one.select("volume", F.lit(kind).alias("kind"), "label", F.lit(mdtype).alias("mdtype"), "content", F.lit(None).cast("string").alias("href"))


def source_events(volumes: DataFrame, captures: DataFrame, selected: DataFrame) -> DataFrame:
    """The events of a source record: its own ones at the time of volumes (volume, made), the capture, and selected ones; each event id once.

    captures and selected have volume, eventid, eventtype, date, detail and agent.
    """
    own = volumes.select("volume", F.explode(F.array(*map(F.lit, OWN_EVENTS))).alias("eventtype"), F.col("made").alias("date"))
    none = F.lit(None).cast("string")
    own = own.select("volume", F.md5(F.concat_ws(":", "volume", "eventtype", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))).alias("eventid"), "eventtype", "date", none.alias("detail"), none.alias("agent"))
    every = own.unionByName(captures.select(own.columns)).unionByName(selected.select(own.columns))
    first = F.min(F.struct("date", "eventtype", "detail", "agent")).alias("e")
    return every.groupBy("volume", "eventid").agg(first).select("volume", "eventid", "e.eventtype", "e.date", "e.detail", "e.agent")


def provenance(events: DataFrame) -> DataFrame:
    """One section a volume that holds its PREMIS events."""
    return event_xml(events).select("volume", F.lit("digiprovMD").alias("kind"), F.lit("PREMIS").alias("label"), F.lit("PREMIS").alias("mdtype"), F.col("xml").alias("content"), F.lit(None).cast("string").alias("href"))


def described_by(files: DataFrame, sections: DataFrame) -> DataFrame:
    """files (volume, label, null for none) with admid, the id of their volume's section of that label; null where there is none."""
    ids = sections.groupBy("volume", "label").agg(F.min("section_id").alias("admid"))
    return files.join(ids, ["volume", "label"], "left")


def _section(s: DataFrame) -> Column:
    about = F.concat(attribute("MDTYPE", s["mdtype"]), attribute("LABEL", s["label"]))
    inside = F.concat(F.lit("<METS:mdWrap"), about, F.lit("><METS:xmlData>"), s["content"], F.lit("</METS:xmlData></METS:mdWrap>"))
    outside = F.concat(F.lit("<METS:mdRef"), about, attribute("xlink:href", s["href"]), F.lit("/>"))
    tag = F.concat(F.lit("METS:"), s["kind"])
    return F.concat(F.lit("<"), tag, attribute("ID", s["section_id"]), F.lit(">"), F.coalesce(inside, outside), F.lit("</"), tag, F.lit(">"))


def assembled(volumes: DataFrame, sections: DataFrame, files: DataFrame) -> DataFrame:
    """(volume, xml): one record for each of volumes (volume, made, status), with sections that are numbered, and files (volume, use, file, file_id, page, size, md5sum, admid).

    Every part becomes a fragment with its place, and one grouping by volume puts
    them together. A volume without sections or files has these parts empty; parts
    of a volume that is not in volumes are left out.
    """
    place = {kind: n for n, kind in enumerate(KINDS)}
    ranked = F.create_map(*(F.lit(x) for pair in place.items() for x in pair))[F.col("kind")]
    parts = [sections.select("volume", ranked.alias("place"), F.lpad(F.regexp_extract("section_id", r"(\d+)$", 1), 10, "0").alias("key"), _section(sections).alias("x"))]
    file = F.concat(F.lit("<METS:file"), attribute("ID", F.col("file_id")), attribute("ADMID", F.col("admid")), attribute("SIZE", F.col("size")), attribute("CHECKSUM", F.col("md5sum")), F.lit("><METS:FLocat"), attribute("xlink:href", F.col("file")), F.lit("/></METS:file>"))
    listed = files.groupBy("volume", "use").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_id", file.alias("x")))), lambda f: f["x"]), "").alias("x"))
    parts.append(listed.select("volume", F.lit(len(KINDS)).alias("place"), F.col("use").alias("key"), F.concat(F.lit("<METS:fileGrp"), attribute("USE", F.col("use")), F.lit(">"), "x", F.lit("</METS:fileGrp>")).alias("x")))
    pointers = F.array_join(F.transform("fileids", lambda i: F.concat(F.lit("<METS:fptr"), attribute("FILEID", i), F.lit("/>"))), "")
    div = F.concat(F.lit("<METS:div"), attribute("ORDER", F.col("position")), F.lit(">"), pointers, F.lit("</METS:div>"))
    parts.append(structure(files.filter("page is not null")).select("volume", F.lit(len(KINDS) + 1).alias("place"), F.lpad(F.col("position").cast("string"), 10, "0").alias("key"), div.alias("x")))
    header = mets_header(F.col("made"), F.col("status"), F.array().cast("array<struct<role:string,type:string,name:string>>"), F.lit(None).cast("string"))
    parts.append(volumes.select("volume", F.lit(-1).alias("place"), F.lit("").alias("key"), header.alias("x")))
    whole = reduce(DataFrame.unionByName, parts).groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("place", "key", "x"))).alias("p"))

    def those(low: int, high: int) -> Column:
        return F.array_join(F.transform(F.filter("p", lambda f: f["place"].between(low, high)), lambda f: f["x"]), "")

    n = len(KINDS)
    xml = F.concat(
        F.lit(f"<METS:mets {NAMESPACES}"), attribute("OBJID", F.col("volume")), F.lit(">"), those(-1, -1), those(0, 0), F.lit('<METS:amdSec ID="AMD1">'), those(1, n - 1), F.lit("</METS:amdSec><METS:fileSec>"),
        those(n, n), F.lit("</METS:fileSec><METS:structMap>"), those(n + 1, n + 1), F.lit("</METS:structMap></METS:mets>"),
    )
    return whole.filter(F.exists("p", lambda f: f["place"] == -1)).select("volume", xml.alias("xml"))


def items(documents: DataFrame) -> DataFrame:
    """Everything that records (volume, xml) hold, from one parse of each: (volume, part, id, refs, name, value, date).

    part is record, section, event, file, page or broken; refs are the ids that a file (ADMID)
    or a page (FILEID) names; name is a section's label, an event's type, or a file's
    href; value is a section's type, an event's agent, a file's checksum. A document
    that does not parse gives one row broken.
    """
    text, none = (lambda c: c.cast("string")), F.lit(None).cast("string")
    no_refs = F.array().cast("array<string>")

    def item(part: str, id_: Column, refs: Column = no_refs, name: Column = none, value: Column = none, date: Column = none) -> Column:
        return F.struct(F.lit(part).alias("part"), text(id_).alias("id"), refs.alias("refs"), text(name).alias("name"), text(value).alias("value"), text(date).alias("date"))

    some = lambda x, kind: F.coalesce(x, F.array().cast(f"array<{kind}>"))
    m = documents.select("volume", F.from_xml("xml", f"{RECORD}, broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "ignoreNamespace": "true"}).alias("m"))
    m = m.withColumn("s", F.concat(some(F.col("m.dmdSec"), SECTION), *(some(F.col(f"m.amdSec.{k}"), SECTION) for k in list(KINDS)[1:])))
    group = f"struct<_USE:string,file:array<{FILE}>>"
    files = F.flatten(F.transform(some(F.col("m.fileSec.fileGrp"), group), lambda g: some(g["file"], FILE)))
    pages = some(F.col("m.structMap.div"), "struct<_ORDER:bigint,_LABEL:string,fptr:array<struct<_FILEID:string>>>")
    events = F.flatten(F.transform("s", lambda s: some(s["mdWrap"]["xmlData"]["premis"]["event"], PREMIS_EVENT)))
    told = F.concat(
        F.array(item("record", F.col("m._OBJID"), name=F.col("m.metsHdr._RECORDSTATUS"), date=F.col("m.metsHdr._CREATEDATE"))),
        F.transform("s", lambda s: item("section", s["_ID"], name=F.coalesce(s["mdWrap"]["_LABEL"], s["mdRef"]["_LABEL"]), value=F.coalesce(s["mdWrap"]["_MDTYPE"], s["mdRef"]["_MDTYPE"]))),
        F.transform(events, lambda e: item("event", e["eventIdentifier"]["eventIdentifierValue"], name=e["eventType"], value=e["linkingAgentIdentifier"]["linkingAgentIdentifierValue"], date=e["eventDateTime"])),
        F.transform(files, lambda f: item("file", f["_ID"], F.filter(F.split(F.coalesce(f["_ADMID"], F.lit("")), r"\s+"), lambda r: r != ""), f["FLocat"]["_href"], f["_CHECKSUM"])),
        F.transform(pages, lambda d: item("page", d["_ORDER"], some(d["fptr"]["_FILEID"], "string"))),
    )
    broken = F.col("m").isNull() | F.col("m.broken").isNotNull()
    # outer: for a plain inline the optimizer would add a filter on the array's size and repeat the parse in it
    return m.select("volume", F.inline_outer(F.when(broken, F.array(item("broken", none))).otherwise(told))).filter("part is not null")


def record_faults(found: DataFrame, required: list[str]) -> DataFrame:
    """What is wrong in items(): (volume, fault, name): broken, dangling (an id named that nothing has), duplicate (an id dealt twice), missing event (a required type).

    A page names files, a file names sections, and a record the event types that it
    must have. Names and those who have them meet in one shuffle, by volume and name.
    """
    text = lambda c: c.cast("string")

    def met(by: str, name: Column, dealt: int) -> Column:
        return F.struct(F.lit(by).alias("by"), text(name).alias("name"), F.lit(dealt).alias("dealt"))

    names = lambda by, refs: F.transform(refs, lambda r: met(by, r, 0))
    part = F.col("part")
    each = (
        F.when(part == "record", names("event", F.array(*map(F.lit, required)).cast("array<string>"))).when(part == "event", F.array(met("event", F.col("name"), 1))).when(part == "page", names("file", F.col("refs")))
        .when(part == "file", F.concat(F.array(met("file", F.col("id"), 1)), names("section", F.col("refs")))).when(part == "section", F.array(met("section", F.col("id"), 1))).when(part == "broken", F.array(met("broken", F.lit(None), 0)))
    )
    rows = found.select("volume", F.inline(each)).filter("name is not null or by = 'broken'")
    counted = rows.groupBy("volume", "by", "name").agg(F.sum("dealt").alias("dealt"))
    none, twice = F.col("dealt") == 0, (F.col("dealt") > 1) & (F.col("by") != "event")
    fault = F.when(F.col("by") == "broken", "broken").when(none & (F.col("by") == "event"), "missing event").when(none, "dangling").when(twice, "duplicate")
    return counted.select("volume", fault.alias("fault"), "name").filter("fault is not null")
