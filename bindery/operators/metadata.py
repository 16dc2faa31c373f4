"""Parts of structural and preservation metadata: events, agents, pages of old and new records, EPUB spines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .documents import attribute


def value_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """The tall table (kind, value, n) of how often each value of each column stands."""
    kinds = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(kinds.alias("v")).filter("v.value is not null").groupBy("v.kind", "v.value").agg(F.count("*").alias("n"))


def last_event(events: DataFrame, eventtype: str) -> DataFrame:
    """(volume, date): the latest event of a type."""
    return events.filter(F.col("eventtype") == eventtype).groupBy("volume").agg(F.max("date").alias("date"))


def method_usage(methods: DataFrame, files: DataFrame) -> DataFrame:
    """(volume, method, n): how many files (volume, admid, a list of ids) refer to each method (volume, techmd, method), zero included."""
    used = files.select("volume", F.explode(F.array_distinct("admid")).alias("techmd")).groupBy("volume", "techmd").agg(F.count("*").alias("used"))
    joined = methods.join(used, ["volume", "techmd"], "left")
    return joined.groupBy("volume", "method").agg(F.sum(F.coalesce("used", F.lit(0))).cast("long").alias("n"))


def page_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each old page (volume, position, label, hrefs) against the new one of its place: same, changed (label or files), missing or ambiguous (several new ones)."""
    shape = lambda df: df.select("volume", "position", F.struct("label", F.array_sort("hrefs").alias("hrefs")).alias("page"))
    newer = shape(new).groupBy("volume", "position").agg(F.first("page").alias("newer"), F.count("*").alias("pages"))
    joined = shape(old).join(newer, ["volume", "position"], "left")
    status = F.when(F.col("pages").isNull(), "missing").when(F.col("pages") > 1, "ambiguous").when(F.col("page").eqNullSafe(F.col("newer")), "same").otherwise("changed")
    return joined.select("volume", "position", status.alias("status"))


def old_page_data(pages: DataFrame, files: DataFrame) -> DataFrame:
    """(volume, href, label, status): the label that an older record gives each file, through the files' ids; NotEqualValues where its pages disagree."""
    labels = pages.join(files.select("volume", "file_id", "href"), ["volume", "file_id"]).groupBy("volume", "href").agg(F.min("label").alias("label"), F.min_by("label", "position").alias("first"), F.count_distinct(F.coalesce("label", F.lit(""))).alias("n"))
    return labels.select("volume", "href", "first", F.when(F.col("n") > 1, "NotEqualValues").otherwise("ok").alias("status")).withColumnRenamed("first", "label")


def spine_texts(books: DataFrame, texts: DataFrame) -> DataFrame:
    """(volume, position, item, file): the n-th item of each book's spine with the text file of that number, null where there is none."""
    spine = books.select("volume", F.posexplode("spine").alias("at", "item"))
    wanted = spine.select("volume", (F.col("at") + 1).alias("position"), "item", F.concat(F.lpad((F.col("at") + 1).cast("string"), 8, "0"), F.lit(".txt")).alias("wanted"))
    return wanted.join(texts.select("volume", F.col("file").alias("wanted"), "file"), ["volume", "wanted"], "left").select("volume", "position", "item", "file")


def sub_files(books: DataFrame, sections: list[str]) -> DataFrame:
    """(volume, section, name, created): the files inside a book, of several lists of (name, checksum, created), without checksums."""
    def listed(section: str) -> Column:
        return F.transform(F.coalesce(section, F.array()), lambda f: F.struct(F.lit(section).alias("section"), f["name"].alias("name"), f["created"].alias("created")))

    return books.select("volume", F.inline(F.concat(*map(listed, sections))))


def book_status(reports: DataFrame) -> DataFrame:
    """(volume, ok): whether all books of a volume are well-formed; a volume without a report is not."""
    return reports.groupBy("volume").agg(F.coalesce(F.bool_and(F.col("status") == "Well-formed"), F.lit(False)).alias("ok"))


def selected_events(wanted: DataFrame, rows: DataFrame, custom: DataFrame) -> DataFrame:
    """The event for each wanted (volume, eventtype, optional): given as XML, else from its row, else left out if optional; MissingField otherwise."""
    joined = wanted.join(custom.select("volume", "eventtype", "xml"), ["volume", "eventtype"], "left").join(rows.select("volume", "eventtype", "eventid", "date"), ["volume", "eventtype"], "left")
    source = F.when(F.col("xml").isNotNull(), "custom").when(F.col("eventid").isNotNull(), "row").when(F.col("optional"), "none").otherwise("MissingField")
    return joined.select("volume", "eventtype", source.alias("source"), "eventid", "date", "xml")


def event_xml(events: DataFrame) -> DataFrame:
    """(volume, xml): the PREMIS events (volume, eventid, eventtype, date, detail, agent) of each volume, in order of time and id."""
    def tag(name: str, value: Column) -> Column:
        safe = F.replace(F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.coalesce(F.concat(F.lit(f"<{name}>"), safe, F.lit(f"</{name}>")), F.lit(""))

    identifier = F.concat(F.lit("<eventIdentifier><eventIdentifierType>UUID</eventIdentifierType>"), tag("eventIdentifierValue", F.col("eventid")), F.lit("</eventIdentifier>"))
    agent = F.concat(F.lit("<linkingAgentIdentifier>"), tag("linkingAgentIdentifierValue", F.col("agent")), F.lit("</linkingAgentIdentifier>"))
    stamp = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    xml = F.concat(F.lit("<event>"), identifier, tag("eventType", F.col("eventtype")), tag("eventDateTime", stamp), tag("eventDetail", F.col("detail")), F.when(F.col("agent").isNotNull(), agent).otherwise(""), F.lit("</event>"))
    rows = events.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("date", "eventid", xml.alias("x")))).alias("e"))
    return rows.select("volume", F.concat(F.lit("<premis>"), F.array_join("e.x", ""), F.lit("</premis>")).alias("xml"))


def read_events(documents: DataFrame) -> DataFrame:
    """(volume, eventid, eventtype, date, detail, agent) of PREMIS documents (volume, xml)."""
    schema = "event array<struct<eventIdentifier: struct<eventIdentifierValue: string>, eventType: string, eventDateTime: string, eventDetail: string, linkingAgentIdentifier: struct<linkingAgentIdentifierValue: string>>>"
    e = documents.select("volume", F.explode(F.from_xml("xml", schema)["event"]).alias("e"))
    return e.select("volume", F.col("e.eventIdentifier.eventIdentifierValue").alias("eventid"), F.col("e.eventType").alias("eventtype"), F.col("e.eventDateTime").alias("date"), F.col("e.eventDetail").alias("detail"), F.col("e.linkingAgentIdentifier.linkingAgentIdentifierValue").alias("agent"))


def mets_header(created: Column, status: Column, agents: Column, number: Column) -> Column:
    """The METS header: when and how the record was made, the agents (role, type, name, which may be null) in order, and the volume's other number."""
    def tag(name: str, value: Column) -> Column:
        safe = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.coalesce(F.concat(F.lit(f"<METS:{name}>"), safe, F.lit(f"</METS:{name}>")), F.lit(""))

    agent = F.transform(agents, lambda a: F.concat(F.lit("<METS:agent"), attribute("ROLE", a["role"]), attribute("TYPE", a["type"]), F.lit(">"), tag("name", a["name"]), F.lit("</METS:agent>")))
    other = tag("altRecordID", number)
    return F.concat(F.lit("<METS:metsHdr"), attribute("CREATEDATE", F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'")), attribute("RECORDSTATUS", status), F.lit(">"), F.array_join(agent, ""), other, F.lit("</METS:metsHdr>"))


def described(sections: Column) -> Column:
    """Metadata sections (kind, id, mdtype, content or href) as METS: what has a content is wrapped, the rest referred to."""
    def one(s: Column) -> Column:
        inside = F.concat(F.lit("<METS:mdWrap"), attribute("MDTYPE", s["mdtype"]), F.lit("><METS:xmlData>"), s["content"], F.lit("</METS:xmlData></METS:mdWrap>"))
        outside = F.concat(F.lit("<METS:mdRef"), attribute("MDTYPE", s["mdtype"]), attribute("xlink:href", s["href"]), F.lit("/>"))
        return F.concat(F.lit("<METS:"), s["kind"], attribute("ID", s["id"]), F.lit(">"), F.coalesce(inside, outside), F.lit("</METS:"), s["kind"], F.lit(">"))

    return F.array_join(F.transform(sections, one), "")


def validated(volumes: DataFrame, stages: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(errors, passed): the errors (volume, stage, code) of all stages, each a function of volumes to (volume, code), and the volumes without any."""
    errors = reduce(DataFrame.unionByName, [check(volumes).select("volume", F.lit(name).alias("stage"), "code") for name, check in stages.items()])
    return errors, volumes.select("volume").distinct().join(errors.select("volume"), "volume", "left_anti")


def single_artist(headers: DataFrame) -> DataFrame:
    """Each file's artist against the first of its volume, by name: ok or NotEqualValues."""
    first = F.first("artist", ignorenulls=True).over(Window.partitionBy("volume").orderBy("file").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return headers.withColumn("first", first).select("volume", "file", F.when(F.col("artist").isNull(), "MissingField").when(F.col("artist") != F.col("first"), "NotEqualValues").otherwise("ok").alias("status"))


def arks(volumes: DataFrame, items: DataFrame) -> DataFrame:
    """volumes (id, an ark) with item and resolution of the archive's table (arkid, item, resolution); MissingField where it has none."""
    joined = volumes.join(items, volumes["id"] == items["arkid"], "left")
    return joined.select(*volumes.columns, "item", "resolution", F.when(F.col("item").isNull(), "MissingField").otherwise("ok").alias("status"))
