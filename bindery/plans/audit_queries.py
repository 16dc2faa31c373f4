"""Queries over the repository's audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit as a
from ..operators import queueing as q
from ..sources import sinks
from .registry import Tables, query

OBJECT = ["namespace", "id", "version", "storage_name", "object_no", "object_part"]
KEYS = ", ".join(OBJECT)


@query("expire_backups", """
  with old as (select *, row_number() over (partition by namespace, id order by version desc, saved_md5sum desc) as r from feed_backups
    where storage_name = 'versioned' and deleted is null and version < '19990704000000')
  select namespace, id, version, saved_md5sum from old where r > 1""", "feed_backups")  # fmt: skip
def expire_backups(t: Tables) -> DataFrame:
    return a.expired(t.feed_backups, "versioned", "1999-12-31 00:00:00").select("namespace", "id", "version", "saved_md5sum")


COMPLETENESS = f"""
  with objects as (select {KEYS}, max(case when ext = 'zip' then 1 else 0 end) as zip, max(case when ext = 'mets.xml' then 1 else 0 end) as mets, 1 as in_storage from storage_listing group by all),
  rows as (select {KEYS}, 1 as in_db from feed_backups where deleted is null),
  sides as (select {KEYS}, coalesce(in_db, 0) as in_db, coalesce(in_storage, 0) as in_storage, case when in_db is null then 1 else 0 end + 2 - coalesce(zip, 0) - coalesce(mets, 0) as errors
    from rows full outer join objects using ({KEYS}))
"""


@query("db_completeness", COMPLETENESS + f"select {KEYS}, errors from sides where in_storage = 1", "storage_listing", "feed_backups")
def db_completeness(t: Tables) -> DataFrame:
    """From storage to the database: stored objects and their errors."""
    return a.completeness(t.feed_backups, t.storage_listing, OBJECT).filter("in_storage = 1").select(*OBJECT, "errors")


@query("storage_completeness", COMPLETENESS + f"select {KEYS}, errors from sides where in_db = 1", "storage_listing", "feed_backups")
def storage_completeness(t: Tables) -> DataFrame:
    """From the database to storage: undeleted rows and their missing files."""
    return a.completeness(t.feed_backups, t.storage_listing, OBJECT).filter("in_db = 1").select(*OBJECT, "errors")


@query("audit_upsert", """
  with new as (select namespace, id, zip_size + 1 as zip_size, 1 as ok from feed_audit where cast(id as bigint) % 3 = 0
    union all select namespace, concat(id, '9'), zip_size, 1 from feed_audit where cast(id as bigint) % 50 = 7)
  select coalesce(f.namespace, n.namespace) as namespace, coalesce(f.id, n.id) as id, case when n.id is not null then n.zip_size else f.zip_size end as zip_size,
    case when n.id is not null then 1 else f.md5check_ok end as md5check_ok, f.page_count
  from (select * from feed_audit where cast(id as bigint) % 50 <> 9) f full outer join (select * from new where not (cast(id as bigint) % 50 = 9 and false)) n on n.namespace = f.namespace and n.id = f.id""", "feed_audit")  # fmt: skip
def audit_upsert(t: Tables) -> DataFrame:
    number = F.col("id").cast("long")
    old = t.feed_audit.filter(number % 50 != 9)
    new = t.feed_audit.filter(number % 3 == 0).select("namespace", "id", (F.col("zip_size") + 1).alias("zip_size"))
    new = new.union(t.feed_audit.filter(number % 50 == 7).select("namespace", F.concat("id", F.lit("9")), "zip_size"))
    return sinks.upsert(old, new, q.KEY, {"md5check_ok": F.lit(1)}).select(*q.KEY, "zip_size", "md5check_ok", "page_count")


@query("fixity_outcome", f"""
  with stored as (select {KEYS}, real_md5sum from storage_listing where ext = 'zip')
  select {KEYS}, cast(case when s.real_md5sum is not null then case when b.saved_md5sum = s.real_md5sum and object_no % 59 > 0 then 1 else 0 end end as integer) as md5check_ok
  from feed_backups b left join stored s using ({KEYS})""", "feed_backups", "storage_listing")  # fmt: skip
def fixity_outcome(t: Tables) -> DataFrame:
    real = t.storage_listing.filter("ext = 'zip'").select(*OBJECT, "real_md5sum")
    mets = F.when(F.col("object_no") % 59 > 0, F.col("saved_md5sum")).otherwise("0")
    return a.fixity(t.feed_backups.withColumn("mets_md5sum", mets), real, OBJECT)


@query("filecount_rule", """
  with counted as (select o_custkey * 5 + o_orderkey % 5 as object_no, count(*) as total, count(*) filter (o_orderstatus = 'F') as zips, count(*) filter (o_orderstatus = 'O') as mets from orders group by 1)
  select object_no, total, case when total between 1 and 2 and mets = 1 and (zips = 1 or object_no % 10 = 0) then 'OK' else 'BAD_FILECOUNT' end as status from counted""")  # fmt: skip
def filecount_rule(t: Tables) -> DataFrame:
    """A customer's orders are dealt to five objects."""
    object_no = F.col("o_custkey") * 5 + F.col("o_orderkey") % 5
    counted = t.orders.groupBy(object_no.alias("object_no")).agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("zips"), F.count_if(F.col("o_orderstatus") == "O").alias("mets"))
    return counted.select("object_no", "total", a.file_count_status(F.col("total"), F.col("zips"), F.col("mets"), F.col("object_no") % 10 == 0).alias("status"))


@query("checkpoint_due", "select namespace, id from feed_audit where lastmd5check is null or lastmd5check <= date '2024-06-01'", "feed_audit")
def checkpoint_due(t: Tables) -> DataFrame:
    return a.due(t.feed_audit, "2024-06-01").select(*q.KEY)


@query("audit_states", "select case md5check_ok when 1 then 'ok' when 0 then 'bad' else 'never' end as state, count(*) as n, sum(zip_size) as bytes from feed_audit group by 1", "feed_audit")
def audit_states(t: Tables) -> DataFrame:
    state = F.when(F.col("md5check_ok") == 1, "ok").when(F.col("md5check_ok") == 0, "bad").otherwise("never")
    return t.feed_audit.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.sum("zip_size").alias("bytes"))


@query("last_error", """
  with ranked as (select *, row_number() over (partition by namespace, id order by logged_at desc, event_id desc) as r from feed_log where level = 'ERROR')
  select namespace, id, event_id, message from ranked where r = 1""", "feed_log")  # fmt: skip
def last_error(t: Tables) -> DataFrame:
    return q.last_errors(t.feed_log).select(*q.KEY, "event_id", "message")


@query("symlink_check", """
  select namespace, id, case when sdr_partition = 1 then 'OK' when cast(id as bigint) % 7 = 0 then 'CANT_LSTAT' when cast(id as bigint) % 11 = 0 then 'SYMLINK_INVALID' else 'OK' end as status from feed_audit""", "feed_audit")  # fmt: skip
def symlink_check(t: Tables) -> DataFrame:
    path = lambda p: F.concat(F.lit("/sdr"), p, F.lit("/obj/"), F.col("namespace"), F.lit("/"), F.col("id"))
    number = F.col("id").cast("long")
    own = F.col("sdr_partition").cast("string")
    links = t.feed_audit.filter(number % 7 > 0).select(*q.KEY, path(F.when(number % 11 == 0, "99").otherwise(own)).alias("target"))
    joined = t.feed_audit.join(links, q.KEY, "left")
    return joined.select(*q.KEY, a.symlink_status(path(own), F.col("sdr_partition"), F.col("target"), path(own)).alias("status"))


@query("restore_states", """
  select namespace, id, case when cast(id as bigint) % 4 = 0 then 'none' when cast(id as bigint) % 3 = 0 or cast(id as bigint) % 5 = 0 then 'pending' else 'restored' end as state from feed_audit""", "feed_audit")  # fmt: skip
def restore_states(t: Tables) -> DataFrame:
    n = F.col("id").cast("long")
    state = a.restore_state(F.when(n % 4 > 0, F.lit("2024-01-01")), F.when(n % 3 > 0, F.lit(False)), n % 5 == 0)
    return t.feed_audit.select(*q.KEY, state.alias("state"))
