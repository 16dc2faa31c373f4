"""Queries over storage rows, store checks and files that are written and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import storage as s
from ..sources import readers, sinks
from ..streaming.jobs import shared_folder
from ..sources.snapshots import Snapshots
from .registry import Tables, query

VERSION = [*s.STORAGE_KEY, "version"]
NOW = "2024-06-01 00:00:00"


@query("audit_locations", """
  select namespace, id, case when cast(id as bigint) % 3 = 0 then sdr_partition + 1 else sdr_partition end as sdr_partition, case when cast(id as bigint) % 3 = 0 then zip_size * 2 else zip_size end as zip_size, md5check_ok from feed_audit""", "feed_audit")  # fmt: skip
def audit_locations(t: Tables) -> DataFrame:
    seen = t.feed_audit.filter(F.col("id").cast("long") % 3 == 0).select("namespace", "id", (F.col("sdr_partition") + 1).alias("sdr_partition"), (F.col("zip_size") * 2).alias("zip_size"), "mets_size")
    return s.audit_locations(t.feed_audit, seen).select("namespace", "id", "sdr_partition", "zip_size", "md5check_ok")


@query("storage_rows", """
  with st as (select namespace, id, site as storage_name, zip_size, lastmd5check from feed_audit cross join (select 'site0' as site union all select 'site1') x)
  select namespace, id, storage_name, case when storage_name = 'site1' and cast(id as bigint) % 4 = 0 then zip_size + 1 else zip_size end as zip_size,
    case when storage_name = 'site1' and cast(id as bigint) % 4 = 0 then timestamp '2024-06-01' else cast(lastmd5check as timestamp) end as deposit_time from st""", "feed_audit")  # fmt: skip
def storage_rows(t: Tables) -> DataFrame:
    """Deposits at one of two sites."""
    storage = t.feed_audit.select("namespace", "id", F.explode(F.array(F.lit("site0"), F.lit("site1"))).alias("storage_name"), "zip_size", "mets_size", F.col("lastmd5check").cast("timestamp").alias("deposit_time"))
    deposits = storage.filter((F.col("storage_name") == "site1") & (F.col("id").cast("long") % 4 == 0)).select(*s.STORAGE_KEY, (F.col("zip_size") + 1).alias("zip_size"), "mets_size")
    return s.stored(storage, deposits, F.lit(NOW).cast("timestamp")).select(*s.STORAGE_KEY, "zip_size", "deposit_time")


@query("backup_versions", """
  with n as (select namespace, id, storage_name, version from feed_backups union all select distinct namespace, id, 'objectstore', '20240601000000' from feed_audit)
  select namespace, id, storage_name, count(*) as versions, max(version) as newest from n group by all""", "feed_backups", "feed_audit")  # fmt: skip
def backup_versions(t: Tables) -> DataFrame:
    deposits = t.feed_audit.select("namespace", "id", F.lit("objectstore").alias("storage_name"), F.lit("20240601000000").alias("version"))
    return s.with_versions(t.feed_backups, deposits).groupBy(*s.STORAGE_KEY).agg(F.count("*").alias("versions"), F.max("version").alias("newest"))


@query("recorded_backups", """
  with d as (select namespace, id, zip_size, mets_size, md5(concat(namespace, '.', id)) as saved_md5sum, coalesce(cast(lastmd5check as timestamp), timestamp '2024-06-01') as moment from feed_audit
    union all select namespace, id, zip_size, mets_size, saved_md5sum, lastchecked from feed_backups where storage_name = 'versioned' and object_part < 3),
  n as (select namespace, id, strftime(moment, '%Y%m%d%H%M%S') as version, moment, zip_size, mets_size, saved_md5sum from d),
  one as (select namespace, id, version, max({'z': zip_size, 'm': mets_size, 's': saved_md5sum}) as r, max(moment) as moment from n group by namespace, id, version)
  select namespace, id, concat_ws('/', '/backup', namespace, substr(id, 1, greatest(length(id) - 4, 3)), concat(id, '.', version, '.zip')) as path, version, r.z as zip_size, r.m as mets_size, r.s as saved_md5sum, moment as lastchecked
  from one where not exists (select 1 from feed_backups b where b.namespace = one.namespace and b.id = one.id and b.version = one.version and b.storage_name = 'versioned')""", "feed_audit", "feed_backups")  # fmt: skip
def recorded_backups(t: Tables) -> DataFrame:
    """New versions of all audited volumes, some of them recorded before, and a run over old ones again."""
    sizes = ["namespace", "id", "zip_size", "mets_size"]
    new = t.feed_audit.select(*sizes, F.md5(F.concat_ws(".", "namespace", "id")).alias("saved_md5sum"), F.coalesce(F.col("lastmd5check").cast("timestamp"), F.lit(NOW).cast("timestamp")).alias("at"))
    again = t.feed_backups.filter("storage_name = 'versioned' and object_part < 3").select(*sizes, "saved_md5sum", F.col("lastchecked").cast("timestamp").alias("at"))
    rows = s.new_versions(t.feed_backups, new.union(again), "versioned", F.lit("/backup"), F.col("at"))
    return rows.select("namespace", "id", "path", "version", "zip_size", "mets_size", "saved_md5sum", "lastchecked")


@query("restore_requests", """
  with asked as (select distinct namespace, id, storage_name, version from feed_backups where object_part = 3 and storage_name = 'versioned')
  select namespace, id, storage_name, version, object_part, case when a.version is not null then null when object_no % 2 = 0 then timestamp '2024-06-01' end as restore_request
  from feed_backups b left join asked a using (namespace, id, storage_name, version)""", "feed_backups")  # fmt: skip
def restore_requests(t: Tables) -> DataFrame:
    """Some objects have asked for a restore; requests of some versions are cleared."""
    at = F.lit(NOW).cast("timestamp")
    backups = t.feed_backups.withColumn("restore_request", F.when(F.col("object_no") % 2 == 0, at))
    done = backups.filter("object_part = 3 and storage_name = 'versioned'")
    return s.restore_requests(backups, done, F.lit(None).cast("timestamp")).select(*VERSION, "object_part", "restore_request")


@query("audit_objects", """
  select namespace, id, version, object_part, coalesce(object_no % 3 > 0, true) as encrypted, concat('/store/', namespace, '/', id, '.', version, case when object_no % 3 > 0 then '.zip.gpg' else '.zip' end) as zip_path, concat('/store/', namespace, '/', id, '.', version, '.mets.xml') as mets_path
  from feed_backups""", "feed_backups")  # fmt: skip
def audit_objects(t: Tables) -> DataFrame:
    rows = t.feed_backups.withColumn("encrypted", F.when(F.col("object_no") % 3 == 0, F.lit(False)))
    return s.audit_objects(rows, F.lit("/store")).select("namespace", "id", "version", "object_part", "encrypted", "zip_path", "mets_path")


@query("store_uploads", """
  select namespace, id, version, object_part, case when object_no % 17 = 0 then 'MISSING' when object_no % 19 = 0 then 'NO_CHECKSUM' when object_no % 23 = 0 then 'BAD_CHECKSUM' else 'OK' end as status from feed_backups""", "feed_backups")  # fmt: skip
def store_uploads(t: Tables) -> DataFrame:
    n = F.col("object_no")
    stored = F.when(n % 19 > 0, F.when(n % 23 == 0, F.lit("other")).otherwise(F.col("saved_md5sum")))
    return t.feed_backups.select("namespace", "id", "version", "object_part", s.store_status(n % 17 > 0, stored, F.col("saved_md5sum")).alias("status"))


@query("zip_checks", """
  with real as (select namespace, id, version, storage_name, object_no, object_part, real_md5sum from storage_listing where ext = 'zip')
  select b.namespace, b.id, b.object_no, b.object_part, cast(case when r.real_md5sum is not null then case when r.real_md5sum = b.saved_md5sum then 1 else 0 end end as integer) as ok, r.real_md5sum
  from feed_backups b left join real r using (namespace, id, version, storage_name, object_no, object_part)""", "feed_backups", "storage_listing")  # fmt: skip
def zip_checks(t: Tables) -> DataFrame:
    keys = [*VERSION, "object_no", "object_part"]
    joined = t.feed_backups.join(t.storage_listing.filter("ext = 'zip'").select(*keys, "real_md5sum"), keys, "left")
    return joined.select("namespace", "id", "object_no", "object_part", s.zip_check(F.col("saved_md5sum"), F.col("real_md5sum")).alias("ok"), "real_md5sum")


@query("link_targets", """
  select p_partkey, case when p_partkey % 3 = 0 then concat('/old/', p_brand) else concat('/new/', p_brand) end as path, p_partkey % 2 = 0 and p_partkey % 5 > 0 as is_repeat from part""")  # fmt: skip
def link_targets(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    where = s.placed(F.concat(F.lit("/new/"), "p_brand"), F.when(n % 3 == 0, F.concat(F.lit("/old/"), "p_brand")), n % 2 == 0, F.when(n % 5 > 0, F.lit(True)))
    return t.part.select("p_partkey", where.alias("w")).select("p_partkey", "w.path", "w.is_repeat")


@query("link_placements", """
  with l as (select namespace, id, min(concat('/', storage_name, '/', version, '/', id)) as target from feed_backups where deleted = 1 group by namespace, id),
  f as (select concat('/', storage_name, '/', version, '/', id) as place, bool_or(ext = 'zip') and bool_or(ext = 'mets.xml') as both from storage_listing group by 1)
  select a.namespace, a.id, coalesce(l.target, concat('/new/', a.id)) as path, coalesce(f.both, false) as is_repeat
  from feed_audit a left join l on l.namespace = a.namespace and l.id = a.id left join f on f.place = coalesce(l.target, concat('/new/', a.id))""", "feed_audit", "feed_backups", "storage_listing")  # fmt: skip
def link_placements(t: Tables) -> DataFrame:
    """Volumes with a link to one of their backups go there, the others to a new place; the files are those of the listing."""
    place = F.concat_ws("/", F.lit(""), "storage_name", "version", "id")
    links = t.feed_backups.filter("deleted = 1").select("namespace", "id", place.alias("target"))
    files = t.storage_listing.select(F.concat_ws("/", place, F.concat_ws(".", "id", "ext")).alias("path"))
    return s.placements(t.feed_audit.select("namespace", "id", F.concat(F.lit("/new/"), "id").alias("path")), links, files)


@query("site_audit", """
  with f as (select p_partkey, site from part cross join (select 'east' as site union all select 'west') x)
  select concat('ns', cast(p_partkey % 5 as varchar)) as namespace, cast(p_partkey as varchar) as id, site,
    case when site = 'west' and p_partkey % 7 = 0 or site = 'east' and p_partkey % (13 * 17) = 0 then 'MISSING' when p_partkey % 11 = 0 then 'BAD_FILE' when p_partkey % 13 = 0 then 'NO_ZIP' when site = 'east' and p_partkey % 17 = 0 then 'NO_METS' else 'OK' end as status
  from f""")  # fmt: skip
def site_audit(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    both = t.part.select(F.concat(F.lit("ns"), n % 5).alias("namespace"), n.cast("string").alias("id"), "p_partkey", F.explode(F.array(F.lit("east"), F.lit("west"))).alias("site"))
    west = F.col("site") == "west"
    rows = both.filter(~(west & (n % 7 == 0))).select("namespace", "id", "site", F.when(n % 13 == 0, 0).otherwise(1).alias("zip"), F.when(~west & (n % 17 == 0), 0).otherwise(1).alias("mets"), F.when(n % 11 == 0, 1).otherwise(0).alias("other"))
    return s.site_facts(rows, ["east", "west"])


@query("bucket_scan", "select distinct cast(o_orderkey as varchar) as id from orders where o_orderkey % 3 = 0 except select id from feed_queue where pkg_type = 'ia'", "feed_queue")
def bucket_scan(t: Tables) -> DataFrame:
    """Every third order has a package and its metadata in the bucket; some are queued."""
    n = F.col("o_orderkey").cast("string")
    keys = t.orders.filter("o_orderkey % 3 = 0").select(F.explode(F.array(F.concat(F.lit("in/"), n, F.lit(".zip")), F.concat(F.lit("in/"), n, F.lit(".xml.gz")))).alias("key"))
    return s.bucket_scan(keys, t.feed_queue.filter("pkg_type = 'ia'"))


@query("bulk_load", "select cast(p_partkey as varchar) as item, case when p_partkey % 2 = 0 then 'new' else 'ns1' end as namespace, concat('ark:/', case when p_partkey % 2 = 0 then p_brand else p_type end) as arkid from part")
def bulk_load(t: Tables) -> DataFrame:
    """Lines for half the items, each twice; the later one counts."""
    item = F.col("p_partkey").cast("string")
    table = t.part.select(item.alias("item"), F.lit("ns1").alias("namespace"), F.concat(F.lit("ark:/"), "p_type").alias("arkid"))
    line = lambda ns, ark: F.concat_ws("\t", item, F.lit(ns), ark)
    both = F.array(F.struct(F.lit(1).cast("long").alias("line_no"), line("old", F.lit("ark:/none")).alias("line")), F.struct(F.lit(2).cast("long").alias("line_no"), line("new", F.concat(F.lit("ark:/"), "p_brand")).alias("line")))
    return s.bulk_load(table, t.part.filter("p_partkey % 2 = 0").select(F.inline(both)), ["item", "namespace", "arkid"], ["item"])


@query("withdrawn_volumes", """
  with gone as (select namespace, id from feed_queue where pkg_type = 'emma' and failure_count > 2)
  select 'queue' as kind, namespace, id from feed_queue where (namespace, id) not in (select (namespace, id) from gone)
  union all (select 'disallow', namespace, id from queue_disallow union select 'disallow', namespace, id from gone)
  union all select 'rights', namespace, id from gone""", "feed_queue", "queue_disallow")  # fmt: skip
def withdrawn_volumes(t: Tables) -> DataFrame:
    rights = t.feed_queue.limit(0).select("namespace", "id", F.lit("none").alias("reason"))
    after = s.withdrawn(t.feed_queue, t.queue_disallow, rights, t.feed_queue.filter("pkg_type = 'emma' and failure_count > 2"), "deleted")
    queue, barred, lines = (df.select(F.lit(kind).alias("kind"), "namespace", "id") for kind, df in zip(("queue", "disallow", "rights"), after))
    return queue.union(barred).union(lines)


@query("handle_rows", """
  select upper(concat('2027/', cast(p_partkey as varchar))) as handle, case when p_partkey % 2 = 0 then concat('https://new/', cast(p_partkey as varchar)) else concat('https://old/', cast(p_partkey as varchar)) end as data from part
  union all select upper(concat('2027/x', cast(p_partkey as varchar))), concat('https://new/x', cast(p_partkey as varchar)) from part where p_partkey % 5 = 0""")  # fmt: skip
def handle_rows(t: Tables) -> DataFrame:
    """Handles of known volumes move, new ones come in."""
    n = F.col("p_partkey").cast("string")
    row = lambda mark, host: t.part.select("p_partkey", F.upper(F.concat(F.lit(f"2027/{mark}"), n)).alias("handle"), F.concat(F.lit(f"https://{host}/{mark}"), n).alias("data"))
    known, moved, fresh = row("", "old"), row("", "new").filter("p_partkey % 2 = 0"), row("x", "new").filter("p_partkey % 5 = 0")
    return sinks.upsert(known.drop("p_partkey"), moved.union(fresh).drop("p_partkey"), ["handle"])


@query("admin_handles", """
  select c_custkey, concat('0FFF', format('{:08X}', length(c_name) + 5), hex(upper(concat('0.na/', c_name))), format('{:08X}', c_custkey), '0000') as record from customer""")  # fmt: skip
def admin_handles(t: Tables) -> DataFrame:
    record = sinks.admin_handle(F.col("c_custkey"), F.lit(4095), F.concat(F.lit("0.na/"), "c_name"))
    return t.customer.select("c_custkey", F.hex(record).alias("record"))


@query("item_cache", """
  select p_partkey as id, case when p_partkey % 3 = 0 then 'chapter 1, chapter 2' else 'all' end as coverage, case when p_partkey % 3 = 0 then 2 else 1 end as version from part""")  # fmt: skip
def item_cache(t: Tables) -> DataFrame:
    """Metadata of a package replaces what is cached, its coverage joined from several elements."""
    cached = t.part.select(F.col("p_partkey").alias("id"), F.lit("all").alias("coverage"), F.lit(1).alias("version"))
    xml = F.concat(F.lit("<emma><c>chapter 1</c><c>chapter 2</c><id>"), F.col("p_partkey"), F.lit("</id></emma>"))
    read = F.from_xml(xml, "id long, c array<string>")
    rows = t.part.filter("p_partkey % 3 = 0").select(read.alias("x")).select("x.id", F.array_join("x.c", ", ").alias("coverage"), F.lit(2).alias("version"))
    return sinks.replace_into(cached, rows, ["id"], "version")


@query("id_file_lines", "select namespace, id from feed_queue", "feed_queue")
def id_file_lines(t: Tables) -> DataFrame:
    """Every volume of the queue written to a file of ids, listed and read again."""
    path = f"{shared_folder(t.spark)}-ids/{uuid.uuid4().hex}"
    sinks.id_file(t.feed_queue, path)
    lines = t.spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path)
    return readers.id_list(lines.withColumnRenamed("value", "line"), dotted=True).select("namespace", "id")


@query("yaml_fields", """
  select cast(n_nationkey as varchar) as volume, case when n_nationkey % 5 = 1 then 'BadFile' when n_nationkey % 5 = 2 then 'MissingFile' end as error,
    case when n_nationkey % 5 in (0, 3, 4) then n_name end as title, case when n_nationkey % 5 in (0, 3, 4) then '2013-11-01T12:31:00-05:00' end as capture_date from nation""")  # fmt: skip
def yaml_fields(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 5
    text = F.when(k == 1, "title: [broken").when(k != 2, F.concat(F.lit("title: '"), "n_name", F.lit("'\ncapture_date: 2013/11/01 12:31:00-05:00\nnested:\n  a: 1\n")))
    rows = readers.yaml_metadata(t.nation.select(F.col("n_nationkey").cast("string").alias("volume"), text.alias("text")))
    return rows.select("volume", "error", *(F.try_element_at("metadata", F.lit(c)).alias(c) for c in ("title", "capture_date")))


@query("zip_sources", """
  select cast(s_suppkey as varchar) as volume, case s_suppkey % 5 when 0 then 'OK' when 1 then 'MULTIPLE' when 2 then 'NO_SOURCE_METS' else 'CANT_UNZIP' end as status from supplier""")  # fmt: skip
def zip_sources(t: Tables) -> DataFrame:
    """Zips with one source record, two, none; cut short; and absent."""
    def packed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for pdf in pdfs:
            out = []
            for n in pdf["s_suppkey"]:
                data, names = io.BytesIO(), {0: ["IA"], 1: ["IA", "UM"]}.get(n % 5, [])
                with zipfile.ZipFile(data, "w") as z:
                    for name in [f"{n}/00000001.txt", *(f"{n}/{x}_{n}.xml" for x in names)]:
                        z.writestr(name, "x")
                out.append((str(n), None if n % 5 == 4 else data.getvalue()[: 30 if n % 5 == 3 else None]))
            yield pd.DataFrame(out, columns=["volume", "content"])

    return readers.zip_source(t.supplier.select("s_suppkey").mapInPandas(packed, "volume string, content binary"))


@query("snapshot_versions", """
  with a as (select namespace, id, zip_size, mets_size, page_count, md5check_ok, cast(id as bigint) as n from feed_audit)
  select 'before' as version, namespace, id, zip_size, mets_size, page_count, md5check_ok from a
  union all select 'after', namespace, id, case when n % 40 = 0 then null else zip_size end, case when n % 40 = 0 then mets_size + 1 else mets_size end, page_count, case when n % 40 = 0 then 1 else md5check_ok end from a
  union all select 'after', concat('new', cast(n as varchar)), id, zip_size, mets_size, null, 1 from a where n % 40 = 1
  union all select 'cut', namespace, id, zip_size, mets_size, page_count, md5check_ok from a where n % 40 > 1
  union all select 'back', namespace, id, zip_size, mets_size, page_count, md5check_ok from a""", "feed_audit")  # fmt: skip
def snapshot_versions(t: Tables) -> DataFrame:
    """A table's versions: made, changed by an upsert of known and new keys, put back, cut by a delete, and put back again."""
    columns = ["namespace", "id", "zip_size", "mets_size", "page_count", "md5check_ok"]
    rows, n = t.feed_audit.select(*columns), F.col("id").cast("long")
    kept = Snapshots(t.spark, f"{shared_folder(t.spark)}/feed_audit", ["namespace", "id"])
    first = kept.create(rows)
    known = rows.filter(n % 40 == 0).select("namespace", "id", F.lit(None).cast("long").alias("zip_size"), (F.col("mets_size") + 1).alias("mets_size"))
    new = rows.filter(n % 40 == 1).select(F.concat(F.lit("new"), n).alias("namespace"), "id", "zip_size", "mets_size")
    second = kept.upsert(known.union(new), {"md5check_ok": F.lit(1)})
    kept.put_back(first)
    third = kept.delete(rows.filter(n % 40 < 2))
    kept.put_back(first)
    named = {"before": first, "after": second, "cut": third, "back": None}
    parts = [kept.read(v).select(F.lit(k).alias("version"), *columns) for k, v in named.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])
