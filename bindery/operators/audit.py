"""Repository audits: completeness both ways, fixity, file counts, retention and their bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OBJECT = ["namespace", "id", "version", "storage_name"]


def expired(backups: DataFrame, storage: str, as_of: str, days: int = 180) -> DataFrame:
    """Undeleted versions of one storage older than the horizon, all but the newest of these for each volume."""
    cutoff = F.date_format(F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)), "yyyyMMddHHmmss")
    old = backups.filter((F.col("storage_name") == storage) & F.col("deleted").isNull() & (F.col("version") < cutoff))
    newest = Window.partitionBy("namespace", "id").orderBy(F.desc("version"), F.desc("saved_md5sum"))
    return old.withColumn("_at", F.row_number().over(newest)).filter("_at > 1").drop("_at")


def objects(listing: DataFrame, keys: list[str]) -> DataFrame:
    """One row per stored object with which of its two files are there."""
    return listing.groupBy(*keys).agg(F.max((F.col("ext") == "zip").cast("int")).alias("zip"), F.max((F.col("ext") == "mets.xml").cast("int")).alias("mets"))


def completeness(backups: DataFrame, listing: DataFrame, keys: list[str]) -> DataFrame:
    """Both directions of the check by one full outer join of rows and stored objects.

    in_db and in_storage say which side has it; errors counts a missing row, and
    each missing file of an object whose row is not deleted.
    """
    rows = backups.filter("deleted is null").select(*keys).withColumn("in_db", F.lit(1))
    joined = rows.join(objects(listing, keys).withColumn("in_storage", F.lit(1)), keys, "full_outer")
    files = F.coalesce("zip", F.lit(0)) + F.coalesce("mets", F.lit(0))
    return joined.select(*keys, F.coalesce("in_db", F.lit(0)).alias("in_db"), F.coalesce("in_storage", F.lit(0)).alias("in_storage"), (F.when(F.col("in_db").isNull(), 1).otherwise(0) + 2 - files).alias("errors"))


def fixity(backups: DataFrame, real: DataFrame, keys: list[str]) -> DataFrame:
    """md5check_ok per object of backups (keys, saved_md5sum, mets_md5sum): the file's checksum equals the row's and the manifest's; null where there is no file."""
    joined = backups.select(*keys, "saved_md5sum", "mets_md5sum").join(real, keys, "left")
    same = F.coalesce(F.col("saved_md5sum") == F.col("real_md5sum"), F.lit(False)) & F.coalesce(F.col("mets_md5sum") == F.col("real_md5sum"), F.lit(False))
    return joined.select(*keys, F.when(F.col("real_md5sum").isNotNull(), same.cast("int")).alias("md5check_ok"))


def file_count_status(total: Column, zips: Column, mets: Column, tombstoned: Column) -> Column:
    """One or two files, one of them the manifest and, unless tombstoned, one the zip."""
    good = total.between(1, 2) & (mets == 1) & ((zips == 1) | tombstoned)
    return F.when(good, "OK").otherwise("BAD_FILECOUNT")


def due(audit: DataFrame, checkpoint: str) -> DataFrame:
    """Objects to check: never checked, or last checked no later than the checkpoint."""
    return audit.filter(F.col("lastmd5check").isNull() | (F.col("lastmd5check") <= F.lit(checkpoint).cast("date")))


def recent(modified: Column, now: Column, days: int = 2) -> Column:
    """Too fresh to audit."""
    return modified >= now - F.make_dt_interval(F.lit(days))


def sample(objects_: DataFrame, seed: int, keys: list[str], n: int = 1) -> DataFrame:
    """n undeleted objects with a checksum and no restore under way (restore_request, if there is such a column), at random.

    The least md5 of seed and key wins, so that the pick depends on nothing but the
    objects: not on files, partitions or retries. Each task keeps n rows.
    """
    eligible = objects_.filter("deleted is null and saved_md5sum is not null")
    if "restore_request" in objects_.columns:
        eligible = eligible.filter("restore_request is null")
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)).cast("binary"))
    return eligible.orderBy(ticket, *keys).limit(n)


def symlink_status(path: Column, partition: Column, target: Column, expected: Column) -> Column:
    """Objects outside the first partition need a link to them, and the right one."""
    return F.when(partition == 1, "OK").when(target.isNull(), "CANT_LSTAT").when(target != expected, "SYMLINK_INVALID").otherwise("OK")


def restore_state(requested: Column, zip_ongoing: Column, mets_ongoing: Column) -> Column:
    """Where a restore from cold storage stands; ongoing is null before an answer."""
    waiting = F.coalesce(zip_ongoing, F.lit(True)) | F.coalesce(mets_ongoing, F.lit(True))
    return F.when(requested.isNull(), "none").when(waiting, "pending").otherwise("restored")
