"""Rows about what is stored where: audit and storage rows, backup versions, restore requests, store checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import version_path
from ..sources import sinks
from ..sources.readers import pairtree_encode

VOLUME = ["namespace", "id"]
#: What each site's row of feed_storage is told apart by.
STORAGE_KEY = [*VOLUME, "storage_name"]


def audit_locations(audit: DataFrame, seen: DataFrame) -> DataFrame:
    """feed_audit after a crawl saw objects (namespace, id, sdr_partition, zip_size, mets_size); the checksum columns keep their values."""
    return sinks.upsert(audit, seen, VOLUME)


def stored(storage: DataFrame, deposits: DataFrame, now: Column) -> DataFrame:
    """feed_storage after deposits (namespace, id, storage_name, zip_size, mets_size), whose time it notes."""
    return sinks.upsert(storage, deposits, STORAGE_KEY, {"deposit_time": now})


def new_versions(backups: DataFrame, deposits: DataFrame, storage_name: str, base: Column, at: Column) -> DataFrame:
    """The rows that record deposits (namespace, id, zip_size, mets_size, saved_md5sum) as backup versions.

    A version is called by its time to the second, under which its zip lies; it counts
    as checked then. One that is recorded already, as after a job that ran again, adds
    no row, and deposits of one version are one. A null time or key is not recorded.
    """
    version = F.date_format(at, "yyyyMMddHHmmss")
    rows = deposits.select(
        *VOLUME, version_path(base, F.col("namespace"), pairtree_encode(F.col("id")), version).alias("path"), version.alias("version"), F.lit(storage_name).alias("storage_name"),
        "zip_size", "mets_size", "saved_md5sum", at.alias("lastchecked"), at.alias("lastmd5check"), F.lit(1).alias("md5check_ok"),
    )
    keys = [*STORAGE_KEY, "version"]
    once = rows.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct(*(c for c in rows.columns if c not in keys))).alias("r")).select(*keys, "r.*").select(*rows.columns)
    return once.join(backups.select(*keys), keys, "left_anti").select(*rows.columns)


def with_versions(backups: DataFrame, deposits: DataFrame) -> DataFrame:
    """feed_backups with one more row for each deposit; earlier versions stay as they are."""
    return backups.unionByName(deposits, allowMissingColumns=True)


def restore_requests(backups: DataFrame, keys: DataFrame, at: Column) -> DataFrame:
    """feed_backups with restore_request set to `at` (null clears it) for the given keys."""
    hit = keys.select(*STORAGE_KEY, "version").distinct().withColumn("_hit", F.lit(True))
    joined = backups.join(hit, [*STORAGE_KEY, "version"], "left")
    return joined.withColumn("restore_request", F.when(F.col("_hit"), at).otherwise(F.col("restore_request"))).select(*backups.columns)


def audit_objects(rows: DataFrame, root: Column) -> DataFrame:
    """rows with the zip's and the manifest's paths, the zip's by whether it is encrypted, which it is unless said otherwise."""
    stem = F.concat_ws("/", root, F.col("namespace"), F.concat_ws(".", F.col("id"), F.col("version")))
    encrypted = F.coalesce("encrypted", F.lit(True))
    return rows.withColumns({"encrypted": encrypted, "zip_path": F.concat(stem, F.when(encrypted, ".zip.gpg").otherwise(".zip")), "mets_path": F.concat(stem, F.lit(".mets.xml"))})


def store_status(exists: Column, stored_md5: Column, md5: Column) -> Column:
    """After an upload: the object is there, carries a checksum, and the right one."""
    return F.when(~F.coalesce(exists, F.lit(False)), "MISSING").when(stored_md5.isNull(), "NO_CHECKSUM").when(stored_md5 != md5, "BAD_CHECKSUM").otherwise("OK")


def zip_check(recorded: Column, real: Column) -> Column:
    """1 where the zip has the recorded checksum, 0 where not, null where there is no zip or nothing is recorded."""
    return F.when(recorded.isNotNull() & real.isNotNull(), (recorded == real).cast("int"))


def placed(configured: Column, link_target: Column, has_zip: Column, has_mets: Column) -> Column:
    """(path, is_repeat): an existing link's target goes before the configured place; both files there make it a repeat."""
    return F.struct(F.coalesce(link_target, configured).alias("path"), (F.coalesce(has_zip, F.lit(False)) & F.coalesce(has_mets, F.lit(False))).alias("is_repeat"))


def placements(deposits: DataFrame, links: DataFrame, files: DataFrame) -> DataFrame:
    """Where deposits (namespace, id, path) go, with is_repeat, by the links (namespace, id, target) and the files (path) that there are.

    A volume with links to several places goes to the first by name. A zip and a METS
    of the volume at its place make it a repeat.
    """
    target = links.groupBy(*VOLUME).agg(F.min("target").alias("_target"))
    parts = F.regexp_extract("path", r"^(.*)/([^/]*)$", 1), F.regexp_extract("path", r"^(.*)/([^/]*)$", 2)
    there = files.select(parts[0].alias("_at"), parts[1].alias("_name")).groupBy("_at").agg(F.collect_set("_name").alias("_names"))
    where = deposits.join(target, VOLUME, "left").withColumn("_at", F.coalesce("_target", "path")).join(there, "_at", "left")
    name = pairtree_encode(F.col("id"))
    has = lambda ending: F.array_contains("_names", F.concat(name, F.lit(ending)))
    found = placed(F.col("path"), F.col("_target"), has(".zip"), has(".mets.xml"))
    return where.withColumn("_w", found).select(*VOLUME, F.col("_w.path").alias("path"), F.col("_w.is_repeat").alias("is_repeat"))


def site_facts(rows: DataFrame, sites: list[str]) -> DataFrame:
    """One row per object and site of (namespace, id, site, zip, mets): what each lacks, and BAD_FILE for files beyond the two."""
    wanted = rows.select(*VOLUME).distinct().withColumn("site", F.explode(F.array(*map(F.lit, sites))))
    status = F.when(F.coalesce("zip", F.lit(0)) + F.coalesce("mets", F.lit(0)) == 0, "MISSING").when(F.col("other") > 0, "BAD_FILE").when(F.col("zip") == 0, "NO_ZIP").when(F.col("mets") == 0, "NO_METS").otherwise("OK")
    return wanted.join(rows, [*VOLUME, "site"], "left").select(*VOLUME, "site", status.alias("status"))


def bucket_scan(keys: DataFrame, queue: DataFrame) -> DataFrame:
    """Ids of store keys, without folders and extensions, that the queue does not have yet; each once."""
    name = F.element_at(F.split("key", "/"), -1)
    found = keys.select(F.regexp_extract(name, r"^([^.]*)", 1).alias("id")).filter("id <> ''").distinct()
    return found.join(queue.select("id"), "id", "left_anti")


def bulk_load(table: DataFrame, lines: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """table after REPLACE by tab-separated lines (line_no, line); the last line of a key wins."""
    parts = F.split("line", "\t")
    rows = lines.select("line_no", *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)))
    return sinks.replace_into(table.withColumn("line_no", F.lit(-1).cast("long")), rows, keys, "line_no").drop("line_no")


def withdrawn(queue: DataFrame, disallowed: DataFrame, rights: DataFrame, volumes: DataFrame, reason: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queue, disallowed, rights) after volumes were deleted: gone from the queue, barred from it, and a line appended to their rights."""
    gone = volumes.select(*VOLUME).distinct()
    barred = disallowed.unionByName(sinks.insert_ignore(disallowed.select(*VOLUME), gone, VOLUME), allowMissingColumns=True)
    return sinks.delete(queue, gone, VOLUME), barred, rights.unionByName(gone.withColumn("reason", F.lit(reason)), allowMissingColumns=True)
