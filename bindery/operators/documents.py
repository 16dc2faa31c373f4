"""Facts from structural metadata (METS), page text (DjVu) and their construction from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METS_SCHEMA = """`METS:fileSec` struct<`METS:fileGrp`: array<struct<_USE: string, `METS:file`: array<struct<_ID: string, _SIZE: bigint, _CHECKSUM: string, `METS:FLocat`: struct<`_xlink:href`: string>>>>>>,
  `METS:structMap` struct<`METS:div`: array<struct<_ORDER: int, _LABEL: string, `METS:fptr`: array<struct<_FILEID: string>>>>>"""
NAMESPACES = 'xmlns:METS="http://www.loc.gov/METS/" xmlns:xlink="http://www.w3.org/1999/xlink"'


def attribute(name: str, value: Column) -> Column:
    """ name="value", or nothing where the value is null."""
    safe = F.replace(F.replace(F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    return F.coalesce(F.concat(F.lit(f' {name}="'), safe, F.lit('"')), F.lit(""))


def with_ids(files: DataFrame) -> DataFrame:
    """Files with an id of their group's prefix and a running number, by name."""
    at = F.row_number().over(Window.partitionBy("volume", "use").orderBy("file"))
    return files.withColumn("file_id", F.concat(F.upper(F.substring("use", 1, 3)), F.lpad(at.cast("string"), 8, "0")))


def structure(files: DataFrame) -> DataFrame:
    """(volume, page, position, fileids): pages numbered from 1 in page order, with their files in name order."""
    pages = files.groupBy("volume", "page").agg(F.array_sort(F.collect_list("file_id")).alias("fileids"))
    return pages.withColumn("position", F.row_number().over(Window.partitionBy("volume").orderBy("page")).cast("long"))


def mets(files: DataFrame) -> DataFrame:
    """(volume, xml): file section by use and structure map, from files (volume, use, file, file_id, page, size, md5sum)."""
    file = F.concat(F.lit("<METS:file"), attribute("ID", F.col("file_id")), attribute("SIZE", F.col("size")), attribute("CHECKSUM", F.col("md5sum")), F.lit("><METS:FLocat"), attribute("xlink:href", F.col("file")), F.lit("/></METS:file>"))
    groups = files.groupBy("volume", "use").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", file.alias("x")))), lambda s: s["x"]), "").alias("x"))
    section = groups.groupBy("volume").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<METS:fileGrp"), attribute("USE", F.col("use")), F.lit(">"), "x", F.lit("</METS:fileGrp>")))), "").alias("files"))
    pointers = F.array_join(F.transform("fileids", lambda i: F.concat(F.lit("<METS:fptr"), attribute("FILEID", i), F.lit("/>"))), "")
    div = F.concat(F.lit("<METS:div"), attribute("ORDER", F.col("position")), F.lit(">"), pointers, F.lit("</METS:div>"))
    maps = structure(files).groupBy("volume").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", div.alias("x")))), lambda s: s["x"]), "").alias("pages"))
    xml = F.concat(F.lit(f"<METS:mets {NAMESPACES}><METS:fileSec>"), "files", F.lit("</METS:fileSec><METS:structMap>"), "pages", F.lit("</METS:structMap></METS:mets>"))
    return section.join(maps, "volume").select("volume", xml.alias("xml"))


def parsed(documents: DataFrame) -> DataFrame:
    """Documents with their XML as a struct, parsed once; malformed XML gives nulls."""
    return documents.withColumn("mets", F.from_xml("xml", METS_SCHEMA, {"mode": "PERMISSIVE"}))


def mets_files(documents: DataFrame) -> DataFrame:
    """One row per file of a METS: volume, use, file_id, size, md5sum, href."""
    groups = parsed(documents).select("volume", F.explode("mets.`METS:fileSec`.`METS:fileGrp`").alias("g"))
    files = groups.select("volume", F.col("g._USE").alias("use"), F.explode("g.`METS:file`").alias("f"))
    return files.select("volume", "use", F.col("f._ID").alias("file_id"), F.col("f._SIZE").alias("size"), F.col("f._CHECKSUM").alias("md5sum"), F.col("f.`METS:FLocat`.`_xlink:href`").alias("href"))


def mets_pages(documents: DataFrame) -> DataFrame:
    """One row per page and file pointer: volume, position, file_id."""
    pages = parsed(documents).select("volume", F.explode("mets.`METS:structMap`.`METS:div`").alias("d"))
    return pages.select("volume", F.col("d._ORDER").cast("long").alias("position"), F.explode("d.`METS:fptr`").alias("p")).select("volume", "position", F.col("p._FILEID").alias("file_id"))


def facts(documents: DataFrame) -> DataFrame:
    """The tall table of audit facts (volume, key, value): pages, files by extension, image bytes; from one parse of each document."""
    fact = lambda key, value: F.struct(key.alias("key"), value.cast("long").alias("value"))
    groups, divs = F.col("mets.`METS:fileSec`.`METS:fileGrp`"), F.col("mets.`METS:structMap`.`METS:div`")
    none = F.array().cast("array<struct<key:string,value:bigint>>")

    def of_group(g: Column) -> Column:
        files = g["METS:file"]
        ext = F.transform(files, lambda f: fact(F.concat(F.lit("filetype "), F.regexp_extract(f["METS:FLocat"]["_xlink:href"], r"\.(\w+)$", 1)), F.lit(1)))
        return F.when(g["_USE"] == "image", F.concat(ext, F.transform(files, lambda f: fact(F.lit("image bytes"), f["_SIZE"])))).otherwise(ext)

    with_files = F.filter(divs, lambda d: F.size(F.coalesce(d["METS:fptr"], F.array())) > 0)
    pages = F.when(F.size(with_files) > 0, F.array(fact(F.lit("pages"), F.size(F.array_distinct(F.transform(with_files, lambda d: d["_ORDER"]))))))
    each = parsed(documents).select("volume", F.inline(F.concat(F.coalesce(F.flatten(F.transform(groups, of_group)), none), F.coalesce(pages, none))))
    return each.groupBy("volume", "key").agg(F.sum("value").alias("value"))


EVENT = "struct<eventType:string,eventDateTime:string,eventIdentifier:struct<eventIdentifierType:string>,linkingAgentIdentifier:array<struct<linkingAgentIdentifierType:string,linkingAgentIdentifierValue:string,linkingAgentRole:string>>>"
#: The sections that may hold metadata, and what may stand in them.
SECTIONS = ("techMD", "rightsMD", "sourceMD", "digiprovMD")
NAMED = "_LABEL:string,_MDTYPE:string,_OTHERMDTYPE:string"
WRAP = f"array<struct<{NAMED},xmlData:struct<premis:struct<event:array<{EVENT}>>,event:array<{EVENT}>,record:array<struct<leader:string>>>>>"
SECTION = f"array<struct<mdWrap:{WRAP},mdRef:array<struct<{NAMED}>>>>"
DIV = "_TYPE:string,_LABEL:string"
AUDIT = f"""fileSec struct<fileGrp:array<struct<_USE:string,file:array<struct<_SIZE:bigint,_CHECKSUM:string,FLocat:array<struct<_href:string>>>>>>>,
  dmdSec {SECTION}, amdSec array<struct<{','.join(f'{s}:{SECTION}' for s in SECTIONS)}>>, structMap array<struct<div:array<struct<{DIV},div:array<struct<{DIV}>>>>>>, broken string"""


def repository_facts(documents: DataFrame) -> DataFrame:
    """All facts of a repository audit from one parse of each METS (volume, xml): volume, kind, name, n, date.

    A document that is not well-formed gives METS_VALID 0 and nothing else; there is no
    check against a schema. Histograms are counted within the document.
    """
    fact = lambda kind, name=None, n=None, date=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None) if name is None else name).cast("string").alias("name"), (F.lit(None) if n is None else n).cast("long").alias("n"), (F.lit(None) if date is None else date).cast("string").alias("date"))
    some = lambda x, kind: F.coalesce(x, F.array().cast(f"array<{kind}>"))
    present = lambda x: F.filter(x, lambda v: v.isNotNull())

    def histogram(kind: str, values: Column) -> Column:
        return F.transform(F.array_distinct(values), lambda v: fact(kind, v, F.size(F.filter(values, lambda w: w == v))))

    m = documents.withColumn("m", F.from_xml("xml", AUDIT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "ignoreNamespace": "true"}))
    file, wrap, ref, event = "struct<_SIZE:bigint,_CHECKSUM:string,FLocat:array<struct<_href:string>>>", WRAP[6:-1], f"struct<{NAMED}>", EVENT
    group = f"struct<_USE:string,file:array<{file}>>"
    sections = F.concat(some(F.col("m.dmdSec"), SECTION[6:-1]), *(_under(F.col("m.amdSec"), s) for s in SECTIONS))
    parts = m.select("volume", "m", some(F.col("m.fileSec.fileGrp"), group).alias("groups"), sections.alias("sections"), F.flatten(F.transform(some(F.col("m.structMap"), f"struct<div:array<struct<{DIV},div:array<struct<{DIV}>>>>>"), lambda s: some(s["div"], f"struct<{DIV},div:array<struct<{DIV}>>>"))).alias("tops"))
    parts = parts.select(
        "volume", "m", "groups", F.flatten(F.transform("groups", lambda g: some(g["file"], file))).alias("files"), F.flatten(F.transform("sections", lambda s: some(s["mdWrap"], wrap))).alias("wraps"), F.flatten(F.transform("sections", lambda s: some(s["mdRef"], ref))).alias("refs"),
        F.filter(F.flatten(F.array(F.transform("tops", lambda d: F.struct(d["_TYPE"].alias("type"), d["_LABEL"].alias("label"))), F.flatten(F.transform("tops", lambda d: F.transform(some(d["div"], f"struct<{DIV}>"), lambda e: F.struct(e["_TYPE"].alias("type"), e["_LABEL"].alias("label"))))))), lambda d: d["type"] == "page").alias("pages"),
    )
    parts = parts.withColumn("events", F.flatten(F.transform("wraps", lambda w: F.concat(some(w["xmlData"]["premis"]["event"], event), some(w["xmlData"]["event"], event)))))
    hrefs = F.transform("files", lambda f: F.get(f["FLocat"], F.lit(0))["_href"])
    agent = lambda e: F.get(F.filter(some(e["linkingAgentIdentifier"], EVENT.partition("linkingAgentIdentifier:array<")[2][:-2]), lambda a: a["linkingAgentRole"] == "Executor"), F.lit(0))["linkingAgentIdentifierValue"]
    of_type = lambda kind: F.filter("events", lambda e: e["eventType"] == kind)
    agents = present(F.flatten(F.transform("events", lambda e: some(e["linkingAgentIdentifier"]["linkingAgentIdentifierType"], "string"))))
    version = F.when(F.exists("wraps", lambda w: w["xmlData"]["premis"].isNotNull()), "premis2").when(F.exists("wraps", lambda w: F.coalesce(w["_MDTYPE"] == "PREMIS", F.lit(False))), "unknown").otherwise("none")
    named = lambda kind: lambda w: fact("METS_MDSEC", F.concat_ws("; ", F.lit(kind), *(F.concat(F.lit(f"{a}="), F.nullif(w[f"_{a}"], F.lit(""))) for a in ("LABEL", "MDTYPE", "OTHERMDTYPE"))))
    zipped = F.get(F.filter("files", lambda f: F.get(f["FLocat"], F.lit(0))["_href"].isin(F.concat("volume", F.lit(".zip")), F.concat(F.url_encode(F.col("volume").cast("string")), F.lit(".zip")))), F.lit(0))["_CHECKSUM"]
    images = F.filter("groups", lambda g: g["_USE"] == "image")
    size = F.aggregate(F.flatten(F.transform(images, lambda g: some(g["file"], file))), F.lit(0).cast("long"), lambda total, f: total + F.coalesce(f["_SIZE"], F.lit(0)))
    records = F.aggregate("wraps", F.lit(0), lambda total, w: total + F.size(some(w["xmlData"]["record"], "struct<leader:string>")))
    told = F.concat(
        F.array(fact("METS_VALID", n=F.lit(1)), fact("PREMIS_VERSION", version), fact("MARC", n=records), fact("PAGES", n=F.size("pages")), fact("PAGETAGS", n=F.size(F.filter("pages", lambda p: F.coalesce(p["label"] != "", F.lit(False))))), fact("IMAGE_SIZE", n=size),
                F.when(F.length(zipped) == 32, fact("ZIP_CHECKSUM", zipped)).otherwise(fact("MISSING_METS_CHECKSUM"))),
        histogram("FILETYPE", F.transform(present(hrefs), lambda h: F.regexp_extract(h, r"\.(\w+)$", 1))), histogram("PREMIS_EVENT_TYPE", present(F.transform("events", lambda e: e["eventIdentifier"]["eventIdentifierType"]))), histogram("PREMIS_AGENT_TYPE", agents),
        F.transform(of_type("capture"), lambda e: fact("CAPTURE", agent(e), date=e["eventDateTime"])), F.transform(of_type("message digest calculation"), lambda e: fact("MD5SUM", agent(e), date=e["eventDateTime"])), F.transform(of_type("ingestion"), lambda e: fact("INGEST", date=e["eventDateTime"])),
        F.transform("wraps", named("mdWrap")), F.transform("refs", named("mdRef")),
    )
    broken = F.col("m").isNull() | F.col("m.broken").isNotNull()
    # outer: for a plain inline the optimizer would add a filter on the array's size and repeat the parse in it
    return parts.select("volume", F.inline_outer(F.when(broken, F.array(fact("METS_VALID", n=F.lit(0)))).otherwise(told)))


def _under(sections: Column, name: str) -> Column:
    none = F.array().cast(f"array<{SECTION[6:-1]}>")
    every = F.coalesce(sections, F.array().cast(f"array<struct<{','.join(f'{s}:{SECTION}' for s in SECTIONS)}>>"))
    return F.flatten(F.transform(every, lambda a: F.coalesce(a[name], none)))


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old files that a new METS lacks (missing) or describes otherwise (changed); ids and dates don't count."""
    joined = old.select("volume", "href", F.struct("size", "md5sum", "use").alias("o")).join(new.select("volume", "href", F.struct("size", "md5sum", "use").alias("n")), ["volume", "href"], "left")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("o").eqNullSafe(F.col("n")), "same").otherwise("changed")
    return joined.select("volume", "href", status.alias("status"))


PAGE_TEXT = "BODY struct<OBJECT: array<struct<_usemap: string, HIDDENTEXT: struct<PARAGRAPH: array<struct<LINE: array<struct<WORD: array<string>>>>>>>>>"


def page_texts(documents: DataFrame) -> DataFrame:
    """Page-coordinate OCR to plain text per page: words joined by spaces, lines by line breaks, paragraphs by one more."""
    objects = documents.select("volume", F.posexplode(F.from_xml("xml", PAGE_TEXT)["BODY"]["OBJECT"]).alias("at", "o"))
    line = lambda x: F.coalesce(F.array_join(x["WORD"], " "), F.lit(""))
    paragraph = lambda x: F.coalesce(F.array_join(F.transform(x["LINE"], line), "\n"), F.lit(""))
    text = F.array_join(F.transform(F.col("o.HIDDENTEXT.PARAGRAPH"), paragraph), "\n\n")
    return objects.select("volume", (F.col("at") + 1).cast("long").alias("page"), F.coalesce(text, F.lit("")).alias("text"))
