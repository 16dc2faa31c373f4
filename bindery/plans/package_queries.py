"""Queries that validate packages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import package as p
from ..sources import paged, readers
from ..streaming.jobs import shared_folder
from .registry import Tables, query


@query("bad_filenames", r"select volume, file from volume_files where not regexp_matches(file, '^(checksum\.md5|meta\.yml|marc\.xml|[0-9]{8}.(html|xml|jp2|tif|txt)|.*\.mets\.xml)')", "volume_files")
def bad_filenames(t: Tables) -> DataFrame:
    return t.volume_files.filter(~F.col("file").rlike(p.VALID_NAMES["simple"])).select("volume", "file")


@query("filegroup_members", "select f.volume, f.file, g.name from volume_files f join filegroups g on regexp_matches(f.file, g.pattern)", "volume_files", "filegroups")
def filegroup_members(t: Tables) -> DataFrame:
    return p.file_groups(t.volume_files, t.filegroups).select("volume", "file", "name")


@query("filegroup_flags", "select distinct f.volume, f.file from volume_files f join filegroups g on regexp_matches(f.file, g.pattern) where g.utf8 = 1", "volume_files", "filegroups")
def filegroup_flags(t: Tables) -> DataFrame:
    return p.file_groups(t.volume_files, t.filegroups.filter("utf8 = 1")).select("volume", "file").distinct()


@query("empty_filegroups", """
  select v.volume, g.name, count(f.file) as n, case when count(f.file) = 0 and g.required = 1 then 'BadFilegroup' else 'ok' end as status
  from (select distinct volume from volume_files) v cross join filegroups g left join volume_files f on f.volume = v.volume and regexp_matches(f.file, g.pattern) group by v.volume, g.name, g.required""", "volume_files", "filegroups")  # fmt: skip
def empty_filegroups(t: Tables) -> DataFrame:
    status = F.when((F.col("n") == 0) & (F.col("required") == 1), "BadFilegroup").otherwise("ok")
    return p.group_counts(t.volume_files, t.filegroups).select("volume", "name", "n", status.alias("status"))


@query("sequence_gaps", """
  with pages as (select distinct volume, page from volume_files), steps as (select volume, case when page > lag(page, 1, 0) over (partition by volume order by page) + 1 then 1 else 0 end as gap from pages)
  select volume, count(*) as pages, cast(sum(gap) as bigint) as gaps from steps group by volume""", "volume_files")  # fmt: skip
def sequence_gaps(t: Tables) -> DataFrame:
    return p.sequence_gaps(t.volume_files.withColumn("page", p.page_number(F.col("file"))))


@query("one_per_page", """
  with grouped as (select f.volume, f.page, g.name, g.required, count(*) as files from volume_files f join filegroups g on regexp_matches(f.file, g.pattern) group by all)
  select volume, page, cast(2 - sum(case when required = 1 then 1 else 0 end) as bigint) as missing_groups, cast(sum(case when files > 1 then 1 else 0 end) as bigint) as crowded_groups from grouped group by volume, page""", "volume_files", "filegroups")  # fmt: skip
def one_per_page(t: Tables) -> DataFrame:
    grouped = p.file_groups(t.volume_files, t.filegroups.withColumn("n_required", F.lit(2)))
    return p.one_per_page(grouped.select("volume", "page", "name", "required", "n_required"))


@query("orphan_pages", """
  with grouped as (select f.volume, f.page, g.required from volume_files f join filegroups g on regexp_matches(f.file, g.pattern))
  select volume, page from grouped group by volume, page having max(required) = 0 or count(*) = count(*) filter (required = 0)
  union all select volume, cast(-1 as bigint) from volume_files group by volume""", "volume_files", "filegroups")  # fmt: skip
def orphan_pages(t: Tables) -> DataFrame:
    """Pages of no required group; and page -1 once for each volume looked at."""
    grouped = p.file_groups(t.volume_files, t.filegroups)
    orphans = grouped.select("volume", "page").distinct().join(grouped.filter("required = 1").select("volume", "page").distinct(), ["volume", "page"], "left_anti")
    return orphans.select("volume", F.col("page").cast("long").alias("page")).union(t.volume_files.select("volume", F.lit(-1).cast("long")).distinct())


@query("checksum_compare", """
  select volume, file, m.md5sum as expected, f.md5sum as actual, case when m.md5sum is null then 'BadChecksum' when f.md5sum is null then 'MissingFile' when m.md5sum <> f.md5sum then 'BadChecksum' else 'ok' end as status
  from volume_files f full outer join manifest m using (volume, file)""", "volume_files", "manifest")  # fmt: skip
def checksum_compare(t: Tables) -> DataFrame:
    return p.checksum_compare(t.volume_files, t.manifest, ["volume", "file"])


@query("checksum_file", """
  with listed as (select volume, file, md5sum, row_number() over (partition by volume order by file) as n from manifest)
  select volume, lower(file) as file, md5sum from listed where n % 5 <> 4""", "manifest")  # fmt: skip
def checksum_file(t: Tables) -> DataFrame:
    """Checksum files as they come: upper case, folders, carriage returns, binary marks, and lines that are none."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("volume").orderBy("file"))
    line = F.when(F.col("line_no") % 5 == 4, F.concat(F.lit("no checksum "), "file")).when(F.col("line_no") % 2 == 0, F.concat(F.upper("md5sum"), F.lit(" *folder/"), F.upper("file"), F.lit(" \r"))).otherwise(F.concat("md5sum", F.lit("  "), "file"))
    lines = t.manifest.withColumn("line_no", n).withColumn("line", line)
    return readers.checksum_lines(lines.select("volume", "line_no", "line"))


@query("manifest_outcome", """
  with checked as (select m.volume, case when f.md5sum is null or f.md5sum <> m.md5sum then case when m.file like '%.txt' then 1 else 2 end else 0 end as severity from manifest m left join volume_files f using (volume, file))
  select volume, case max(severity) when 2 then 'fail' when 1 then 'warning' else 'pass' end as outcome, count(*) filter (severity > 0) as failed from checked group by volume""", "manifest", "volume_files")  # fmt: skip
def manifest_outcome(t: Tables) -> DataFrame:
    return p.manifest_outcome(t.manifest, t.volume_files, F.col("file").endswith(".txt"))


@query("unchecked_files", "select volume, file from volume_files except select volume, file from manifest", "volume_files", "manifest")
def unchecked_files(t: Tables) -> DataFrame:
    return t.volume_files.select("volume", "file").subtract(t.manifest.select("volume", "file"))


@query("all_file_names", "select volume, file from volume_files union select volume, file from manifest", "volume_files", "manifest")
def all_file_names(t: Tables) -> DataFrame:
    return t.volume_files.select("volume", "file").union(t.manifest.select("volume", "file")).distinct()


@query("utf8_control_scan", r"""
  select doc_id, case when regexp_matches(case when doc_id % 50 = 0 then concat(text, chr(1)) when doc_id % 50 = 1 then concat(text, chr(13)) when doc_id % 50 = 2 then concat(text, chr(9)) else text end, '[\x00-\x08\x0B-\x1F]') then 'BadUTF' else 'ok' end as status from documents""")  # fmt: skip
def utf8_control_scan(t: Tables) -> DataFrame:
    rest = F.col("doc_id") % 50
    text = F.when(rest == 0, F.concat("text", F.lit("\x01"))).when(rest == 1, F.concat("text", F.lit("\r"))).when(rest == 2, F.concat("text", F.lit("\t"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", p.bytes_status(F.encode(text, "UTF-8")).alias("status"))


@query("group_intersection", "select volume, file from volume_files where volume % 2 = 0 intersect select volume, file from manifest where volume % 3 = 0", "volume_files", "manifest")
def group_intersection(t: Tables) -> DataFrame:
    return t.volume_files.filter("volume % 2 = 0").select("volume", "file").intersect(t.manifest.filter("volume % 3 = 0").select("volume", "file"))


@query("event_merge", """
  with ranked as (select *, row_number() over (partition by volume, eventid order by origin desc, date desc, event_id desc) as r from premis_events)
  select volume, eventid, eventtype, event_id from ranked where r = 1""", "premis_events")  # fmt: skip
def event_merge(t: Tables) -> DataFrame:
    return p.merge_events(t.premis_events).select("volume", "eventid", "eventtype", "event_id")


@query("required_events", """
  with seen as (select volume, list(distinct eventtype) as types from premis_events group by volume)
  select volume, array_to_string(list_sort(list_filter(['capture', 'ingestion', 'message digest calculation', 'validation'], lambda x: not list_contains(types, x))), ',') as missing from seen""", "premis_events")  # fmt: skip
def required_events(t: Tables) -> DataFrame:
    return p.missing_events(t.premis_events, ["capture", "message digest calculation", "ingestion", "validation"])


@query("event_count_equality", """
  with old as (select eventtype, count(*) as n from premis_events where origin = 0 group by 1), new as (select eventtype, count(*) as n from premis_events where origin = 1 group by 1)
  select eventtype, coalesce(old.n, 0) as old_n, coalesce(new.n, 0) as new_n, coalesce(old.n, 0) = coalesce(new.n, 0) as same from old full outer join new using (eventtype)""", "premis_events")  # fmt: skip
def event_count_equality(t: Tables) -> DataFrame:
    count = lambda o, name: t.premis_events.filter(F.col("origin") == o).groupBy("eventtype").agg(F.count("*").alias(name))
    joined = count(0, "old_n").join(count(1, "new_n"), "eventtype", "full_outer").fillna(0, ["old_n", "new_n"])
    return joined.withColumn("same", F.col("old_n") == F.col("new_n"))


@query("deleted_pages", """
  with pages as (select conv_id as volume, turn + 1 as page, case when turn % 4 = 3 then 'Delete' else 'Normal' end as page_type, case when turn % 5 = 4 then 'false' else 'true' end as in_access from conversations),
  present as (select distinct volume, page, 1 as here from volume_files)
  select volume, page, case when here = 1 and (page_type = 'Delete' or in_access = 'false') then 'unlink' when here = 1 then 'keep' when page_type = 'Delete' or in_access = 'false' then 'ok' else 'error' end as action
  from pages left join present using (volume, page)""", "volume_files")  # fmt: skip
def deleted_pages(t: Tables) -> DataFrame:
    pages = t.conversations.select(F.col("conv_id").alias("volume"), (F.col("turn") + 1).alias("page"), F.when(F.col("turn") % 4 == 3, "Delete").otherwise("Normal").alias("page_type"), F.when(F.col("turn") % 5 == 4, "false").otherwise("true").alias("in_access"))
    return p.deleted_pages(pages, t.volume_files)


@query("page_files", """
  select volume, page, string_agg(case when ext in ('jp2', 'tif') then file end, ',' order by file) as image, string_agg(case when ext = 'txt' then file end, ',' order by file) as ocr from volume_files group by volume, page""", "volume_files")  # fmt: skip
def page_files(t: Tables) -> DataFrame:
    """Files by page and group, as the structure map needs them."""
    of = lambda *e: F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("ext").isin(*e), F.col("file")))), ","), F.lit(""))
    return t.volume_files.groupBy("volume", "page").agg(of("jp2", "tif").alias("image"), of("txt").alias("ocr"))


@query("volume_counts", "select volume, count(*) filter (ext in ('jp2', 'tif')) as pages, count(*) as files, cast(sum(size) as bigint) as bytes from volume_files group by volume", "volume_files")
def volume_counts(t: Tables) -> DataFrame:
    return t.volume_files.groupBy("volume").agg(F.count_if(F.col("ext").isin("jp2", "tif")).alias("pages"), F.count("*").alias("files"), F.sum("size").cast("long").alias("bytes"))


@query("link_scan", """select page_id, len(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) as n_links, array_to_string(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1), ' ') as links from pages""")
def link_scan(t: Tables) -> DataFrame:
    found = readers.links(F.col("html"))
    return t.pages.select("page_id", F.size(found).cast("long").alias("n_links"), F.array_join(found, " ").alias("links"))


@query("link_selection", """select page_id, list_filter(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1), lambda x: x like '%1' and x not like '%11')[1] as link from pages""")
def link_selection(t: Tables) -> DataFrame:
    return t.pages.select("page_id", readers.first_link(readers.links(F.col("html")), "1", "11").alias("link"))


@query("versioned_listing", "select namespace, id, version, string_agg(distinct ext, ',' order by ext) as files from storage_listing group by namespace, id, version", "storage_listing")
def versioned_listing(t: Tables) -> DataFrame:
    files = t.storage_listing.select(F.concat_ws("/", F.lit("/backup"), "namespace", F.lit("abc"), F.concat_ws(".", "id", "version", "ext")).alias("path"))
    return readers.versioned_objects(files).withColumn("files", F.array_join("files", ","))


@query("store_listing", "select namespace, id, version, string_agg(distinct ext, ',' order by ext) as files from storage_listing group by namespace, id, version", "storage_listing")
def store_listing(t: Tables) -> DataFrame:
    keys = t.storage_listing.select(F.concat_ws(".", "namespace", "id", "version", "ext").alias("key"))
    return readers.store_objects(keys).withColumn("files", F.array_join("files", ","))


@query("paged_store_listing", "select namespace, id, version, string_agg(distinct ext, ',' order by ext) as files from storage_listing group by namespace, id, version", "storage_listing")
def paged_store_listing(t: Tables) -> DataFrame:
    """The listing of a store that gives its keys in pages, read over ranges of keys."""
    keys = t.storage_listing.select(F.concat_ws(".", "namespace", "id", "version", "ext").alias("key"), F.col("object_no").alias("size"))
    t.spark.dataSource.register(paged.PagedListing)
    store = paged.inventory(keys, shared_folder(t.spark))
    found = t.spark.read.format("paged_listing").options(client="bindery.sources.paged:Inventory", store=store).load()
    return readers.store_objects(found).withColumn("files", F.array_join("files", ","))


@query("repository_walk", "select sdr_partition, namespace, id, concat(id, '.mets.xml,', id, '.zip') as files from feed_audit", "feed_audit")
def repository_walk(t: Tables) -> DataFrame:
    from ..functions.scalars import pairtree_path

    folder = pairtree_path(F.concat(F.lit("/sdr"), F.col("sdr_partition").cast("string"), F.lit("/obj")), F.col("namespace"), F.col("id"))
    names = F.array(F.concat("id", F.lit(".zip")), F.concat("id", F.lit(".mets.xml")), F.lit("Thumbs.db"))
    files = t.feed_audit.select(F.explode(F.transform(names, lambda n: F.concat_ws("/", folder, n))).alias("path"))
    return readers.object_folders(files).select("sdr_partition", "namespace", "id", F.array_join("files", ",").alias("files"))


@query("id_list", "select 'ia' as pkg_type, concat('ns', cast(c_custkey % 5 as string)) as namespace, cast(c_custkey as string) as id from customer")
def id_list(t: Tables) -> DataFrame:
    ns = F.concat(F.lit("ns"), (F.col("c_custkey") % 5).cast("string"))
    dotted = readers.id_list(t.customer.filter("c_custkey % 2 = 0").select(F.concat_ws(".", ns, F.col("c_custkey").cast("string")).alias("line")), dotted=True, pkg_type="ia")
    words = readers.id_list(t.customer.filter("c_custkey % 2 = 1").select(F.concat(F.lit(" ia "), ns, F.lit("\t"), F.col("c_custkey").cast("string")).alias("line")))
    return dotted.union(words)
