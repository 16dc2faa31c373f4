"""Queries over events, agents, pages of old and new records, and EPUB spines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metadata as m
from .registry import Tables, query


@query("agent_histogram", """
  select 'eventtype' as kind, eventtype as value, count(*) as n from premis_events group by 2 union all select 'origin', cast(origin as varchar), count(*) from premis_events group by 2""", "premis_events")  # fmt: skip
def agent_histogram(t: Tables) -> DataFrame:
    return m.value_counts(t.premis_events, "eventtype", "origin")


@query("last_ingest", "select volume, max(date) as date from premis_events where eventtype = 'ingestion' group by volume", "premis_events")
def last_ingest(t: Tables) -> DataFrame:
    return m.last_event(t.premis_events, "ingestion")


@query("method_usage", """
  select volume, concat('method', cast(k as varchar)) as method, count(*) filter (page % 3 = k or (ext = 'xml' and k = 0)) as n from volume_files cross join (select 0 as k union all select 1 union all select 2) x group by volume, k""", "volume_files")  # fmt: skip
def method_usage(t: Tables) -> DataFrame:
    """Every file refers to the method of its page, and XML to the first one as well."""
    tech = lambda n: F.concat(F.lit("TMD"), n.cast("string"))
    ids = F.array_compact(F.array(tech(F.col("page") % 3), F.when(F.col("ext") == "xml", "TMD0")))
    k = F.explode(F.array(*map(F.lit, range(3))))
    methods = t.volume_files.select("volume").distinct().select("volume", k.alias("k")).select("volume", tech(F.col("k")).alias("techmd"), F.concat(F.lit("method"), "k").alias("method"))
    return m.method_usage(methods, t.volume_files.select("volume", ids.alias("admid")))


@query("page_changes", """
  with p as (select distinct volume, page as position from volume_files)
  select volume, position, case when position % 11 = 0 then 'missing' when position % 5 = 0 then 'ambiguous' when position % 3 = 0 or volume % 4 = 0 then 'changed' else 'same' end as status from p""", "volume_files")  # fmt: skip
def page_changes(t: Tables) -> DataFrame:
    """New records that lack a page, have it twice, label it otherwise or leave files out."""
    at, label = F.col("position"), F.concat(F.lit("p. "), F.col("position").cast("string"))
    pages = t.volume_files.groupBy("volume", F.col("page").alias("position")).agg(F.collect_list("file").alias("hrefs"))
    old = pages.withColumn("label", label)
    new = pages.filter(at % 11 > 0).withColumns({"label": F.when(at % 3 == 0, "other").otherwise(label), "hrefs": F.when(F.col("volume") % 4 == 0, F.slice("hrefs", 2, 99)).otherwise(F.reverse("hrefs"))})
    return m.page_changes(old, new.withColumn("twice", F.explode(F.when(at % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))))


@query("old_page_data", """
  select volume, file as href, concat('p. ', cast(page as varchar)) as label, case when page = 2 and ext = 'jp2' then 'NotEqualValues' else 'ok' end as status from volume_files""", "volume_files")  # fmt: skip
def old_page_data(t: Tables) -> DataFrame:
    """Labels by file; in one case a second page has the same file under another label."""
    files = t.volume_files.select("volume", F.concat("ext", F.lit(":"), "file").alias("file_id"), F.col("file").alias("href"))
    own = t.volume_files.select("volume", F.col("page").alias("position"), F.concat(F.lit("p. "), F.col("page").cast("string")).alias("label"), F.concat("ext", F.lit(":"), "file").alias("file_id"))
    again = own.filter("position = 2 and file_id like 'jp2%'").select("volume", (F.col("position") + 1000).alias("position"), F.lit("p. two").alias("label"), "file_id")
    return m.old_page_data(own.union(again), files)


@query("spine_texts", """
  with s as (select conv_id as volume, row_number() over (partition by conv_id order by turn) as position, concat('item', cast(turn as varchar)) as item from conversations)
  select s.volume, cast(position as integer) as position, item, f.file from s left join volume_files f on f.volume = s.volume and f.ext = 'txt' and f.file = concat(lpad(cast(position as varchar), 8, '0'), '.txt')""", "volume_files")  # fmt: skip
def spine_texts(t: Tables) -> DataFrame:
    spine = F.transform(F.array_sort(F.collect_list("turn")), lambda n: F.concat(F.lit("item"), n.cast("string")))
    return m.spine_texts(t.conversations.groupBy(F.col("conv_id").alias("volume")).agg(spine.alias("spine")), t.volume_files.filter("ext = 'txt'"))


@query("sub_files", """
  select volume, case ext when 'txt' then 'text' when 'xml' then 'manifest' else 'image' end as section, file as name, '2024-01-02T00:00:00Z' as created from volume_files""", "volume_files")  # fmt: skip
def sub_files(t: Tables) -> DataFrame:
    file = F.struct(F.col("file").alias("name"), F.col("md5sum").alias("checksum"), F.lit("2024-01-02T00:00:00Z").alias("created"))
    lists = {"text": F.col("ext") == "txt", "manifest": F.col("ext") == "xml", "image": F.col("ext").isin("jp2", "tif")}
    books = t.volume_files.groupBy("volume").agg(*(F.collect_list(F.when(test, file)).alias(k) for k, test in lists.items()))
    return m.sub_files(books, list(lists))


@query("book_checks", "select l_orderkey as volume, bool_and(l_returnflag <> 'R') as ok from lineitem group by l_orderkey")
def book_checks(t: Tables) -> DataFrame:
    status = F.when(F.col("l_returnflag") != "R", "Well-formed").otherwise("Not well-formed")
    return m.book_status(t.lineitem.select(F.col("l_orderkey").alias("volume"), status.alias("status")))


@query("selected_events", """
  with r as (select volume, eventtype, min(eventid) as eventid from premis_events group by all), v as (select distinct volume from premis_events), w as (select volume, eventtype, eventtype <> 'capture' as optional from v cross join (select 'capture' as eventtype union all select 'ingestion' union all select 'validation') x)
  select w.volume, w.eventtype, case when w.volume % 5 = 0 and w.eventtype = 'capture' then 'custom' when r.eventid is not null then 'row' when optional then 'none' else 'MissingField' end as source from w left join r using (volume, eventtype)""", "premis_events")  # fmt: skip
def selected_events(t: Tables) -> DataFrame:
    rows = t.premis_events.groupBy("volume", "eventtype").agg(F.min("eventid").alias("eventid"), F.min("date").alias("date"))
    volumes = t.premis_events.select("volume").distinct()
    kinds = F.explode(F.array(*map(F.lit, ("capture", "ingestion", "validation"))))
    wanted = volumes.select("volume", kinds.alias("eventtype")).withColumn("optional", F.col("eventtype") != "capture")
    custom = volumes.filter("volume % 5 = 0").select("volume", F.lit("capture").alias("eventtype"), F.lit("<event/>").alias("xml"))
    return m.selected_events(wanted, rows, custom).select("volume", "eventtype", "source")


@query("event_round_trip", """
  select volume, eventid, eventtype, strftime(date, '%Y-%m-%dT%H:%M:%SZ') as date, case when event_id % 2 = 0 then 'a < b & c' end as detail, case when origin > 0 then concat('agent', cast(origin as varchar)) end as agent from premis_events""", "premis_events")  # fmt: skip
def event_round_trip(t: Tables) -> DataFrame:
    """Events written as one PREMIS document a volume and read again."""
    detail = F.when(F.col("event_id") % 2 == 0, "a < b & c")
    rows = t.premis_events.withColumns({"detail": detail, "agent": F.when(F.col("origin") > 0, F.concat(F.lit("agent"), F.col("origin")))})
    return m.read_events(m.event_xml(rows))


@query("mets_headers", """
  select o_orderkey, concat('<METS:metsHdr CREATEDATE="', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ'), '" RECORDSTATUS="NEW"><METS:agent ROLE="CREATOR" TYPE="ORGANIZATION"><METS:name>ns', cast(o_custkey % 5 as varchar), '</METS:name></METS:agent>',
    case when o_orderkey % 2 = 0 then concat('<METS:altRecordID>', cast(o_custkey as varchar), '</METS:altRecordID>') else '' end, '</METS:metsHdr>') as header from orders""")  # fmt: skip
def mets_headers(t: Tables) -> DataFrame:
    agent = F.struct(F.lit("CREATOR").alias("role"), F.lit("ORGANIZATION").alias("type"), F.concat(F.lit("ns"), F.col("o_custkey") % 5).alias("name"))
    return t.orders.select("o_orderkey", m.mets_header(F.col("o_orderdate"), F.lit("NEW"), F.array(agent), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string"))).alias("header"))


@query("mets_sections", """
  select p_partkey, concat('<METS:dmdSec ID="DMD1"><METS:mdWrap MDTYPE="MARC"><METS:xmlData><r/></METS:xmlData></METS:mdWrap></METS:dmdSec><METS:techMD ID="TMD1"><METS:mdRef MDTYPE="PREMIS" xlink:href="', p_brand, '"/></METS:techMD>') as sections from part""")  # fmt: skip
def mets_sections(t: Tables) -> DataFrame:
    section = lambda kind, id_, mdtype, content, href: F.struct(F.lit(kind).alias("kind"), F.lit(id_).alias("id"), F.lit(mdtype).alias("mdtype"), content.cast("string").alias("content"), href.cast("string").alias("href"))
    sections = F.array(section("dmdSec", "DMD1", "MARC", F.lit("<r/>"), F.lit(None)), section("techMD", "TMD1", "PREMIS", F.lit(None), F.col("p_brand")))
    return t.part.select("p_partkey", m.described(sections).alias("sections"))


@query("validation_stages", """
  with v as (select p_partkey as volume, p_size, p_retailprice from part), e as (select volume, 'size' as stage, 'BadValue' as code from v where p_size > 40 union all select volume, 'price', 'MissingField' from v where p_retailprice < 1000)
  select volume, stage, code from e union all select volume, 'passed', 'ok' from v where volume not in (select volume from e)""")  # fmt: skip
def validation_stages(t: Tables) -> DataFrame:
    volumes = t.part.select(F.col("p_partkey").alias("volume"), "p_size", "p_retailprice")
    stages = {"size": lambda v: v.filter("p_size > 40").withColumn("code", F.lit("BadValue")), "price": lambda v: v.filter("p_retailprice < 1000").withColumn("code", F.lit("MissingField"))}
    errors, passed = m.validated(volumes, stages)
    return errors.union(passed.select("volume", F.lit("passed").alias("stage"), F.lit("ok").alias("code")))


@query("artists", """
  with f as (select volume, file, case when page % 6 = 5 then null when page % 7 = 3 then 'other' else 'studio' end as artist from volume_files), a as (select volume, arg_min(artist, file) as first from f where artist is not null group by volume)
  select f.volume, file, case when artist is null then 'MissingField' when artist <> first then 'NotEqualValues' else 'ok' end as status from f left join a using (volume)""", "volume_files")  # fmt: skip
def artists(t: Tables) -> DataFrame:
    return m.single_artist(t.volume_files.withColumn("artist", F.when(F.col("page") % 6 != 5, F.when(F.col("page") % 7 == 3, "other").otherwise("studio"))))


@query("ark_lookup", """
  select cast(p_partkey as varchar) as id, case when p_partkey % 4 > 0 then p_brand end as item, case when p_partkey % 4 > 0 then p_size * 10 end as resolution, case when p_partkey % 4 > 0 then 'ok' else 'MissingField' end as status from part""")  # fmt: skip
def ark_lookup(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    items = t.part.filter("p_partkey % 4 > 0").select(key.alias("arkid"), F.col("p_brand").alias("item"), (F.col("p_size") * 10).alias("resolution"))
    return m.arks(t.part.select(key.alias("id")), items)
