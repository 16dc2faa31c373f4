"""Queries over whole METS records: put together from all their tables, read back, and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import documents as d
from ..operators import wholerecord as w
from .registry import Tables, query

#: What both queries compare with: the tables of a record's parts, and its items as they should be read back.
PARTS = """
  with v as (select conv_id as volume, count(*) as n, timestamp '2024-01-01 00:00:00' + to_minutes(conv_id) as made from conversations where conv_id is not null group by conv_id),
  f as (select volume, case when ext in ('jp2', 'tif') then 'image' when ext = 'txt' then 'ocr' else 'coordOCR' end as use, file, page, md5sum from volume_files),
  g as (select f.*, concat(upper(substr(use, 1, 3)), lpad(cast(row_number() over (partition by volume, use order by file) as varchar), 8, '0')) as file_id, case when use = 'image' and v.n % 3 > 0 then 'TMD1' end as admid from f join v using (volume)),
  own as (select volume, eventtype, made as date from v cross join (select unnest(['source metadata creation', 'page md5 creation', 'metadata validation']) as eventtype) x),
  e as (select volume, md5(concat(volume, ':', eventtype, ':', strftime(date, '%Y-%m-%d %H:%M:%S'))) as eventid, eventtype, date, null as agent from own
    union all select volume, eventid, eventtype, date, agent from (
      select volume, eventid, eventtype, date, concat('agent', cast(origin as varchar)) as agent, row_number() over (partition by volume, eventid order by date, origin) as r from premis_events join v using (volume) where eventtype in ('capture', 'ingestion')) x where r = 1),
  p as (select volume, cast(row_number() over (partition by volume order by page) as varchar) as id, string_agg(file_id, ' ' order by file_id) as refs from g group by volume, page),
  s as (select volume, 'DMD1' as id, 'MARC' as name, 'MARC' as value from v union all select volume, 'DPMD1', 'PREMIS', 'PREMIS' from v union all select volume, 'TMD1', 'IA scandata', 'OTHER' from v where n % 3 > 0
    union all select volume, case when n % 3 > 0 then 'TMD2' else 'TMD1' end, 'IA scanfactors', 'OTHER' from v where n % 2 = 0)"""


def records(t: Tables) -> DataFrame:
    """A record of each conversation as a volume: its files, the scan data it has, and the events of its capture and ingestion."""
    made = F.timestamp_seconds(F.lit(1704067200) + F.col("volume") * 60).cast(t.premis_events.schema["date"].dataType)
    volumes = t.conversations.filter("conv_id is not null").groupBy(F.col("conv_id").alias("volume")).agg(F.count("*").alias("n")).withColumns({"made": made, "status": F.lit("NEW")})
    book = F.concat(F.lit('<book pages="'), F.col("n").cast("string"), F.lit('"/>'))
    given = volumes.withColumns({"marc": F.lit("<record><leader>a &amp; b</leader></record>"), "scandata": F.when(F.col("n") % 3 > 0, book), "scanfactors": F.when(F.col("n") % 2 == 0, book)})
    rows = t.premis_events.join(volumes.select("volume"), "volume", "left_semi").withColumns({"agent": F.concat(F.lit("agent"), F.col("origin").cast("string")), "detail": F.lit("<&>")})
    events = w.source_events(volumes, rows.filter("eventtype = 'capture'"), rows.filter("eventtype = 'ingestion'"))
    technical = w.present(given, {"scandata": "IA scandata", "scanfactors": "IA scanfactors"})
    sections = w.numbered(w.present(given, {"marc": "MARC"}, "dmdSec", "MARC").unionByName(technical).unionByName(w.provenance(events)))
    use = F.when(F.col("ext").isin("jp2", "tif"), "image").when(F.col("ext") == "txt", "ocr").otherwise("coordOCR")
    files = d.with_ids(t.volume_files.withColumn("use", use)).withColumn("label", F.when(F.col("use") == "image", "IA scandata"))
    return w.assembled(volumes, sections, w.described_by(files, sections))


@query("whole_records", f"""{PARTS}
  select volume, 'section' as part, id, '' as refs, name, value, null as date from s union all select volume, 'event', eventid, '', eventtype, agent, strftime(date, '%Y-%m-%dT%H:%M:%SZ') from e
  union all select volume, 'file', file_id, coalesce(admid, ''), file, md5sum, null from g union all select volume, 'page', id, refs, null, null, null from p
  union all select volume, 'record', cast(volume as varchar), '', 'NEW', null, strftime(made, '%Y-%m-%dT%H:%M:%SZ') from v""", "volume_files", "premis_events")  # fmt: skip
def whole_records(t: Tables) -> DataFrame:
    return w.items(records(t)).withColumn("refs", F.array_join("refs", " "))


@query("record_faults", f"""{PARTS},
  whole as (select volume from v where volume % 11 > 0),
  named as (select distinct volume, admid as name from g where admid is not null and volume % 4 = 0 union select volume, file_id from g where use = 'coordOCR' and volume % 5 = 0 union select volume, file_id from g where file_id = 'OCR00000002' and volume % 7 = 0)
  select volume, 'broken' as fault, null as name from v where volume % 11 = 0
  union all select volume, 'dangling', name from named where volume in (from whole)
  union all select volume, 'duplicate', 'OCR00000001' from g where file_id = 'OCR00000002' and volume % 7 = 0 and volume in (from whole)
  union all select volume, 'missing event', x.name from whole cross join (select unnest(['capture', 'ingestion', 'page md5 creation']) as name) x where not exists (select 1 from e where e.volume = whole.volume and e.eventtype = x.name)""", "volume_files", "premis_events")  # fmt: skip
def record_faults(t: Tables) -> DataFrame:
    """Records that lost their technical metadata or a group of files, deal an id twice, or end too early."""
    n = F.col("volume")
    xml = F.when(n % 4 == 0, F.regexp_replace("xml", "<METS:techMD.*?</METS:techMD>", "")).otherwise(F.col("xml"))
    xml = F.when(n % 5 == 0, F.regexp_replace(xml, '<METS:fileGrp USE="coordOCR">.*?</METS:fileGrp>', "")).otherwise(xml)
    xml = F.when(n % 7 == 0, F.replace(xml, F.lit(' ID="OCR00000002"'), F.lit(' ID="OCR00000001"'))).otherwise(xml)
    xml = F.when(n % 11 == 0, F.left(xml, F.length(xml) - 20)).otherwise(xml)
    return w.record_faults(w.items(records(t).withColumn("xml", xml)), ["capture", "ingestion", "page md5 creation"])
