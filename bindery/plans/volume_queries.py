"""Queries over choices and checks about whole volumes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import documents, machine, package
from ..operators import volumes as v
from .check_queries import pick
from .document_queries import volume_mets
from ..streaming.jobs import shared_folder
from .registry import Tables, query


@query("tiff_xmp", "select p_partkey, case when p_size % 3 = 1 then concat('<x>', p_brand, '</x>') end as xmp, case p_size % 3 when 0 then 'skipped' when 1 then 'ok' else 'BadField' end as status from part")
def tiff_xmp(t: Tables) -> DataFrame:
    packets = F.array_repeat(F.concat(F.lit("<x>"), "p_brand", F.lit("</x>")), (F.col("p_size") % 3).cast("int"))
    return t.part.select("p_partkey", v.tiff_xmp(packets).alias("x")).select("p_partkey", "x.xmp", "x.status")


@query("jp2_xmp", "select p_partkey, case when p_size % 4 > 1 then concat('<x>', p_brand, '</x>') end as xmp, case when p_size % 4 > 1 then 'ok' else 'BadField' end as status from part")
def jp2_xmp(t: Tables) -> DataFrame:
    """Images with the XMP box twice, not at all, and once."""
    mine, other = F.array(*map(F.lit, v.XMP_BOX)), F.array_repeat(F.lit(7), 16)
    box = lambda uuid, text: F.struct(uuid.alias("uuid"), F.encode(text, "UTF-8").alias("data"))
    xmp, junk, k = box(mine, F.concat(F.lit("<x>"), "p_brand", F.lit("</x>"))), box(other, F.lit("junk")), F.col("p_size") % 4
    boxes = F.when(k == 0, F.array(xmp, junk, xmp)).when(k == 1, F.array(junk)).otherwise(F.array(junk, xmp))
    return t.part.select("p_partkey", v.jp2_xmp(boxes).alias("x")).select("p_partkey", "x.xmp", "x.status")


@query("xmp_values", "select p_partkey, case when p_size % 3 = 0 then p_brand end as value, case p_size % 3 when 0 then 'ok' when 1 then 'MissingField' else 'BadField' end as status from part")
def xmp_values(t: Tables) -> DataFrame:
    xmp = pick(F.col("p_size"), "<x><Artist>", "<x><Make>", "<x><Artist>")
    xmp = F.concat(xmp, "p_brand", pick(F.col("p_size"), "</Artist></x>", "</Make></x>", "</x>"))
    return t.part.select("p_partkey", v.xmp_value(xmp, "Artist").alias("x")).select("p_partkey", "x.value", "x.status")


@query("migrated_events", """
  with m as (select event_id, unnest(case eventtype when 'capture' then ['scan', 'image capture'] when 'ingestion' then ['deposit'] else [eventtype] end) as eventtype from premis_events)
  select event_id, eventtype, true as has_id from m""", "premis_events")  # fmt: skip
def migrated_events(t: Tables) -> DataFrame:
    """One old type becomes two new ones, another is renamed; each event has an id of its own form."""
    renames = t.spark.createDataFrame([("capture", "scan"), ("capture", "image capture"), ("ingestion", "deposit")], "eventtype string, new_type string")
    events = t.premis_events.select("event_id", "eventtype", F.lit("ns").alias("namespace"), F.col("volume").cast("string").alias("id"), F.col("date").cast("string").alias("date"))
    done = v.migrated_events(events, renames)
    return done.select("event_id", "eventtype", F.col("eventid").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-3[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("has_id"))


@query("complete_events", """
  with r as (select *, row_number() over (partition by volume, eventid order by date desc, event_id desc) as r from premis_events where origin > 0 or event_id % 2 = 0)
  select volume, eventid, event_id from r where r = 1""", "premis_events")  # fmt: skip
def complete_events(t: Tables) -> DataFrame:
    detail = F.when((F.col("origin") > 0) | (F.col("event_id") % 2 == 0), "detail")
    return v.complete_events(t.premis_events.withColumn("detail", detail), ["eventid", "eventtype", "date", "detail"]).select("volume", "eventid", "event_id")


@query("id_checks", "select s_suppkey, case when s_suppkey % 4 = 0 then 'MissingField' when s_suppkey % 4 = 1 then 'NotEqualValues' else 'ok' end as status from supplier")
def id_checks(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    return t.supplier.select("s_suppkey", v.id_status(F.when(n % 4 == 1, "other").when(n % 4 > 1, F.col("s_name")), F.col("s_name")).alias("status"))


@query("scandata_sources", """
  select p_partkey, case when p_partkey % 2 = 0 then 'source record' when p_partkey % 3 = 0 then 'download' end as source, case when p_partkey % 2 = 0 then p_brand when p_partkey % 3 = 0 then p_type end as value from part""")  # fmt: skip
def scandata_sources(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    found = v.preferred({"source record": F.when(n % 2 == 0, F.col("p_brand")), "download": F.when(n % 3 == 0, F.col("p_type"))})
    return t.part.select("p_partkey", found.alias("f")).select("p_partkey", "f.source", "f.value")


@query("put_back", """
  select namespace, id, case when cast(id as bigint) % 6 = 0 then sdr_partition else sdr_partition + 100 end as sdr_partition from feed_audit where cast(id as bigint) % 5 > 0 or cast(id as bigint) % 6 = 0""", "feed_audit")  # fmt: skip
def put_back(t: Tables) -> DataFrame:
    """A run has moved every sixth object; those of other runs stay moved or gone."""
    n, keys = F.col("id").cast("long"), ["namespace", "id"]
    old = t.feed_audit.select(*keys, "sdr_partition")
    now = old.filter(n % 5 > 0).withColumn("sdr_partition", F.col("sdr_partition") + 100)
    return v.put_back(now, old, t.feed_audit.filter(n % 6 == 0), keys)


@query("zip_completeness", """
  with f as (select s_suppkey, name from supplier cross join (select 'a.txt' as name union all select 'b.txt') x where s_suppkey % 4 < 3 or name = 'a.txt')
  select cast(s_suppkey as varchar) as volume, name as file, case when s_suppkey % 4 = 0 then 'MissingFile' when s_suppkey % 4 = 1 and name = 'b.txt' then 'BadChecksum' else 'ok' end as status from f
  union all select cast(s_suppkey as varchar), 'b.txt', 'BadChecksum' from supplier where s_suppkey % 4 = 3""")  # fmt: skip
def zip_completeness(t: Tables) -> DataFrame:
    """Zips against their records: unreadable, one member changed, right, one member unlisted."""
    def packed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for pdf in pdfs:
            out = []
            for n in pdf["s_suppkey"]:
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w") as z:
                    z.writestr(f"{n}/A.txt", "a")
                    z.writestr(f"{n}/B.txt", "changed" if n % 4 == 1 else "b")
                out.append((str(n), b"no zip" if n % 4 == 0 else data.getvalue()))
            yield pd.DataFrame(out, columns=["volume", "content"])

    members = v.zip_members(t.supplier.select("s_suppkey").mapInPandas(packed, "volume string, content binary")).filter("file is not null")
    listed = F.when(F.col("s_suppkey") % 4 < 3, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    record = t.supplier.select(F.col("s_suppkey").cast("string").alias("volume"), F.explode(listed).alias("x")).select("volume", F.concat("x", F.lit(".txt")).alias("file"), F.md5(F.col("x").cast("binary")).alias("md5sum"))
    return package.checksum_compare(members, record, ["volume", "file"]).select("volume", "file", "status")


PAGES_ZIPPED = """
  m as (select volume, file, text, case when volume % 7 = 3 then 'none' when volume % 5 = 2 and second then 'locked' else 'whole' end as held from (
    select doc_id as volume, 'Text.TXT' as file, coalesce(text, '') as text, false as second from documents union all select doc_id, 'Source.xml', coalesce(source, ''), true from documents)),
  u as (select volume, case when held = 'none' then null else file end as file, case when held = 'whole' then cast(octet_length(encode(text)) as bigint) end as size, case when held = 'whole' then md5(text) end as md5sum,
    case held when 'whole' then 'ok' when 'locked' then 'warning' else 'error' end as status from m)"""


def zipped_texts(t: Tables) -> DataFrame:
    """(volume, content): a zip of each document's text and source; of some the second member is encrypted, some are cut short."""
    def packed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for pdf in pdfs:
            out, size = [], 0
            for n, text, source in zip(pdf["n"].tolist(), pdf["text"], pdf["source"]):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"{n}/Text.TXT", text)
                    z.writestr(f"{n}/Source.xml", source)
                    second = z.infolist()[1].header_offset
                raw = bytearray(held.getvalue())
                if n % 5 == 2:  # the bit for encryption, in the member's header and in the directory's entry
                    raw[second + 6] |= 1
                    raw[raw.rindex(b"PK\x01\x02") + 8] |= 1
                out.append((str(n), bytes(raw[: len(raw) // 2] if n % 7 == 3 else raw)))
                size += len(raw)
                if size > 4_000_000:  # a task holds the zips of a part of its batch only
                    yield pd.DataFrame(out, columns=["volume", "content"])
                    out, size = [], 0
            yield pd.DataFrame(out, columns=["volume", "content"])

    texts = t.documents.filter("doc_id is not null").select(F.col("doc_id").alias("n"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"))
    return texts.mapInPandas(packed, "volume string, content binary")


@query("unpacked_members", f"with {PAGES_ZIPPED} select distinct cast(volume as varchar) as volume, lower(file) as file, size, md5sum, status from u")
def unpacked_members(t: Tables) -> DataFrame:
    return v.unpacked(zipped_texts(t)).distinct()


@query("unpack_outcomes", f"with {PAGES_ZIPPED} select cast(volume as varchar) as volume, case when max(status = 'error') then 'error' when max(status = 'warning') then 'warning' else 'ok' end as status, count(*) filter (status = 'ok') as n from u group by volume")
def unpack_outcomes(t: Tables) -> DataFrame:
    """Zips that are whole, that lack a member which could not be opened, and that can't be read."""
    zips = zipped_texts(t)
    return v.unpack_outcomes(zips, v.unpacked(zips, keep_case=True))


@query("unpacked_from", "select p_partkey, case when p_partkey % 3 = 0 then 'sip' when p_partkey % 3 = 1 then 'failed' end as source from part")
def unpacked_from(t: Tables) -> DataFrame:
    """A package waits where it succeeded, or where it failed the last time."""
    k = F.col("p_partkey") % 3
    return t.part.select("p_partkey", v.preferred({"sip": F.when(k == 0, "x"), "failed": F.when(k < 2, "x")}).alias("f")).select("p_partkey", "f.source")


@query("repository_sources", "select volume, case when volume % 3 > 0 then 'IA_' || cast(volume as varchar) || '.xml' end as record from (select distinct volume from volume_files)", "volume_files")
def repository_sources(t: Tables) -> DataFrame:
    names = t.volume_files.groupBy("volume").agg(F.collect_set("file").alias("names"))
    more = F.when(F.col("volume") % 3 > 0, F.array_append("names", F.concat(F.lit("IA_"), F.col("volume"), F.lit(".xml")))).otherwise(F.col("names"))
    return names.select("volume", v.source_record(more).alias("record"))


@query("quarantine", """
  with q as (select namespace, id, namespace = 'ns0' and length(id) < 4 or namespace = 'ns1' and id not like '%1' as bad from feed_queue)
  select namespace, count(*) filter (not bad) as valid, count(*) filter (bad) as quarantined from q group by namespace""", "feed_queue")  # fmt: skip
def quarantine(t: Tables) -> DataFrame:
    """Two namespaces check their ids, each by a rule of its own."""
    valid, bad = v.parted(t.feed_queue, {"ns0": F.length("id") >= 4, "ns1": F.col("id").endswith("1")})
    both = valid.select("namespace", F.lit(1).alias("ok")).union(bad.select("namespace", F.lit(0).alias("ok")))
    return both.groupBy("namespace").agg(F.count_if(F.col("ok") == 1).alias("valid"), F.count_if(F.col("ok") == 0).alias("quarantined"))


@query("tool_reports", "select volume, file, case when page % 7 = 0 then 'MissingFile' else 'ok' end as status from volume_files where ext = 'jp2'", "volume_files")
def tool_reports(t: Tables) -> DataFrame:
    """A tool's output over a volume's images, some of which it left out."""
    images = t.volume_files.filter("ext = 'jp2'")
    block = F.concat(F.lit('<repInfo uri="'), "file", F.lit('">\n<status>ok</status>\n</repInfo>\n'))
    streams = images.groupBy("volume").agg(F.array_join(F.collect_list(F.when(F.col("page") % 7 > 0, block)), "").alias("output"))
    reports = v.report_blocks(streams)
    return reports.select("volume", "file", F.lit("ok").alias("status")).union(v.unreported(images.select("volume", "file"), reports).select("volume", "file", F.lit("MissingFile")))


@query("report_stream", """
  with f as (select concat(cast(volume as varchar), '/', file) as uri, page, volume from volume_files where ext = 'jp2'),
  n as (select *, case when page % 7 = 0 then 0 when (volume + page) % 11 = 0 then 2 else 1 end as n, (volume + page) % 13 = 0 as broken from f)
  select uri, cast(n as bigint) as n, case when n > 0 and not broken then 'Well-Formed and valid' end as status,
    case when n = 0 then 'MissingFile' when n > 1 then 'BadField' when broken then 'BadFile' else 'ok' end as outcome, case when n = 1 and not broken then concat('error ', cast(page as varchar)) end as error from n
  union all select concat(cast(volume as varchar), '/stray.jp2'), 1, 'Well-Formed and valid', 'Unexpected', 'error 0' from (select distinct volume from f where volume % 9 = 0)""", "volume_files")  # fmt: skip
def report_stream(t: Tables) -> DataFrame:
    """A tool's output over all images, written as files and read back by byte ranges; it has left out some images, taken others twice, and one file that nobody asked for."""
    images = t.volume_files.filter("ext = 'jp2'").select("volume", "page", F.concat_ws("/", "volume", "file").alias("uri"))
    stray = images.filter("volume % 9 = 0").select("volume", F.lit(0).alias("page"), F.concat(F.col("volume"), F.lit("/stray.jp2")).alias("uri")).distinct()
    times = F.when(F.col("uri").endswith("stray.jp2"), 1).when(F.col("page") % 7 == 0, 0).when((F.col("volume") + F.col("page")) % 11 == 0, 2).otherwise(1)
    end = F.when(((F.col("volume") + F.col("page")) % 13 == 0) & ~F.col("uri").endswith("stray.jp2"), "<status>").otherwise("<status>Well-Formed and valid</status>")
    block = F.concat(F.lit('<repInfo uri="'), "uri", F.lit('">\n'), end, F.lit('\n<messages><message severity="info">fine</message><message severity="error">error '), "page", F.lit("</message></messages>\n</repInfo>"))
    folder = f"{shared_folder(t.spark)}/reports"
    images.union(stray).withColumn("times", times).filter("times > 0").select(F.array_join(F.array_repeat(block, F.col("times")), "\n").alias("value")).write.text(folder)
    reports = v.read_reports(t.spark, folder)
    told = reports.groupBy("uri").agg(F.max(F.get("errors", F.lit(0))).alias("error"))
    done = v.report_outcomes(images, reports).join(told, "uri", "left")
    return done.select("uri", "n", "status", "outcome", F.when(F.col("n") == 1, F.col("error")).alias("error"))


@query("log_history", "select event_id, row_number() over (partition by namespace, id order by logged_at, event_id) as place from feed_log", "feed_log")
def log_history(t: Tables) -> DataFrame:
    return v.history(t.feed_log, ["namespace", "id"]).select("event_id", "place")


@query("exception_sets", """
  select p_partkey, case when p_partkey % 2 = 0 then 'dates,size' || case when p_partkey % 3 = 0 then ',width' else '' end else 'dates,size' end as merged, 'dates,size' as replaced from part""")  # fmt: skip
def exception_sets(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    stored = F.when(n % 2 == 0, F.array_compact(F.array(F.lit("size"), F.when(n % 3 == 0, F.lit("width")))))
    given = F.array(F.lit("size"), F.lit("dates"), F.lit("size"))
    return t.part.select("p_partkey", F.array_join(v.merged_exceptions(stored, given), ",").alias("merged"), F.array_join(v.merged_exceptions(stored, given, replace=True), ",").alias("replaced"))


@query("store_paths", """
  select s_suppkey, concat('ns.', replace(s_name, '.', ','), '.20240101.zip') as key, concat('/base/.tmp/ns.', replace(s_name, '.', ',')) as staging from supplier""")  # fmt: skip
def store_paths(t: Tables) -> DataFrame:
    pt = F.translate("s_name", ".", ",")
    return t.supplier.select("s_suppkey", v.store_key(F.lit("ns"), pt, F.lit("20240101")).alias("key"), v.staging_path(F.lit("/base"), F.lit("ns"), pt).alias("staging"))


@query("dataset_paths", """
  select s_suppkey, case when s_suppkey % 3 > 0 then concat('/set/ns/pairtree_root/ab/', lpad(cast(s_suppkey % 100 as varchar), 2, '0'), '/ab', lpad(cast(s_suppkey % 100 as varchar), 2, '0')) end as path from supplier""")  # fmt: skip
def dataset_paths(t: Tables) -> DataFrame:
    """Paths in a named set, null where nothing is there."""
    pt = F.concat(F.lit("ab"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"))
    wanted = t.supplier.select("s_suppkey", scalars.pairtree_path(F.lit("/set"), F.lit("ns"), pt).alias("wanted"))
    there = wanted.filter("s_suppkey % 3 > 0").select(F.col("wanted").alias("path")).distinct()
    return t.supplier.select("s_suppkey").join(wanted, "s_suppkey").join(there, (F.col("wanted") == F.col("path")) & (F.col("s_suppkey") % 3 > 0), "left").select("s_suppkey", "path")


@query("scan_resolutions", "select p_partkey, cast(case when p_partkey % 2 = 0 then 300 when p_partkey % 3 = 0 then 400 when p_partkey % 5 > 0 then p_size end as integer) as dpi from part")
def scan_resolutions(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    item = F.when(n % 5 == 0, "unknown").when(n % 5 == 1, F.concat("p_size", F.lit("ppi"))).otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", v.scan_resolution(F.when(n % 2 == 0, 300), F.when(n % 3 == 0, 400), item).alias("dpi"))


@query("item_outcomes", """
  select p_partkey, case when p_partkey % 4 = 0 then 'fail' when p_partkey % 3 = 0 then 'warning' else 'pass' end as outcome from part""")  # fmt: skip
def item_outcomes(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    links = F.array_compact(F.array(F.when(n % 4 > 0, F.concat("p_brand", F.lit("_meta.xml"))), F.when(n % 3 > 0, F.concat("p_brand", F.lit("_scan.log"))), F.lit("other.txt")))
    return t.part.select("p_partkey", v.item_outcome(links, {"meta": "_meta.xml"}, {"log": "_scan.log"}).alias("outcome"))


@query("copied_record", """
  select volume, use, file as href, md5sum, file_id, size from (
    select volume, file, md5sum, size, case when ext in ('jp2', 'tif') then 'image' when ext = 'txt' then 'ocr' else 'coordOCR' end as use,
      concat(case when ext in ('jp2', 'tif') then 'IMA' when ext = 'txt' then 'OCR' else 'COO' end, lpad(cast(row_number() over (partition by volume, case when ext in ('jp2', 'tif') then 1 when ext = 'txt' then 2 else 3 end order by file) as varchar), 8, '0')) as file_id from volume_files) f
  union all select distinct volume, 'zip archive', concat(cast(volume as varchar), '.zip'), md5(cast(volume as varchar)), 'ZIP00000001', cast(1 as bigint) from volume_files""", "volume_files")  # fmt: skip
def copied_record(t: Tables) -> DataFrame:
    """A repository record from a source record: its files and pages, and the zip as a group of its own."""
    source = volume_mets(t)
    files, pages = documents.mets_files(source), documents.mets_pages(source)
    paged = files.join(pages, ["volume", "file_id"]).withColumnsRenamed({"href": "file", "position": "page"})
    name = F.col("volume").cast("string")
    archive = source.select("volume", F.lit("zip archive").alias("use"), F.lit("ZIP00000001").alias("file_id"), F.lit(1).cast("long").alias("size"), F.md5(name.cast("binary")).alias("md5sum"), F.concat(name, F.lit(".zip")).alias("file"), F.lit(1).cast("long").alias("page"))
    return documents.mets_files(documents.mets(paged.unionByName(archive))).select("volume", "use", "href", "md5sum", "file_id", "size")


@query("migration_deposit", """
  select namespace, id, case when cast(id as bigint) % 5 = 1 then 'stage' when cast(id as bigint) % 7 = 0 then 'move' end as failed from feed_audit""", "feed_audit")  # fmt: skip
def migration_deposit(t: Tables) -> DataFrame:
    """The deposit's chain without its check for completeness."""
    n = F.col("id").cast("long")
    return t.feed_audit.select("namespace", "id", machine.first_failure(("stage", n % 5 != 1), ("move", n % 7 != 0)).alias("failed"))


@query("mets_counts", """
  select volume, 'tagged pages' as key, count(distinct page) as value from volume_files where page % 4 = 0 group by volume union all select volume, 'image bytes', cast(sum(size) as bigint) from volume_files where ext in ('jp2', 'tif') group by volume""", "volume_files")  # fmt: skip
def mets_counts(t: Tables) -> DataFrame:
    """Labelled pages and the bytes of images."""
    tagged = t.volume_files.filter("page % 4 = 0").groupBy("volume").agg(F.count_distinct("page").alias("value"))
    facts = documents.facts(volume_mets(t)).filter("key = 'image bytes'")
    return tagged.select("volume", F.lit("tagged pages").alias("key"), "value").union(facts.select("volume", "key", "value"))
