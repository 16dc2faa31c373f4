"""Package validation: file names, file groups, page sequences, checksums, text encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a file of each package type may be called.
VALID_NAMES = {
    "ia": r"^(IA_ark\+=13960=\w+\.(xml)|\d{8}\.(xml|jp2|txt))",
    "epub": r"^(checksum\.md5|meta\.yml|marc\.xml|[a-zA-Z0-9._-]+\.epub|[a-zA-Z0-9._-]+\.pdf|[a-zA-Z0-9._-]+\.txt|.*\.mets\.xml)",
    "simple": r"^(checksum\.md5|meta\.yml|marc\.xml|\d{8}.(html|xml|jp2|tif|txt)|.*\.mets\.xml)",
}


def file_groups(files: DataFrame, groups: DataFrame) -> DataFrame:
    """Each file with each group whose pattern it matches; groups is a table of a few rows per package type."""
    return files.join(groups, F.expr("file rlike pattern"))


def group_counts(files: DataFrame, groups: DataFrame) -> DataFrame:
    """(volume, name, required, n) for every volume and group, zero included."""
    volumes = files.select("volume").distinct().crossJoin(F.broadcast(groups.select("name", "required")))  # groups: a few rows
    counted = file_groups(files, groups).groupBy("volume", "name").agg(F.count("*").alias("n"))
    return volumes.join(counted, ["volume", "name"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def page_number(file: Column) -> Column:
    return F.nullif(F.regexp_extract(file, r"(\d+)\.(\w+)$", 1), F.lit("")).cast("int")


def sequence_gaps(pages: DataFrame) -> DataFrame:
    """(volume, pages, gaps): steps of more than one between neighbouring page numbers, from zero."""
    before = F.lag("page", 1, 0).over(Window.partitionBy("volume").orderBy("page"))
    steps = pages.select("volume", "page").distinct().withColumn("gap", (F.col("page") > before + 1).cast("long"))
    return steps.groupBy("volume").agg(F.count("*").alias("pages"), F.sum("gap").alias("gaps"))


def one_per_page(grouped: DataFrame) -> DataFrame:
    """(volume, page, missing_groups, crowded_groups) from (volume, page, name, required, n_required)."""
    by_group = grouped.groupBy("volume", "page", "name", "required", "n_required").agg(F.count("*").alias("files"))
    return by_group.groupBy("volume", "page").agg(
        (F.first("n_required") - F.sum(F.when(F.col("required") == 1, 1).otherwise(0))).alias("missing_groups"), F.sum((F.col("files") > 1).cast("long")).alias("crowded_groups"),
    )


def checksum_compare(files: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """One row per name of either side: ok, BadChecksum (unlisted or different) or MissingFile."""
    joined = files.select(*keys, F.lower("md5sum").alias("actual")).join(manifest.select(*keys, F.lower("md5sum").alias("expected")), keys, "full_outer")
    status = F.when(F.col("expected").isNull(), "BadChecksum").when(F.col("actual").isNull(), "MissingFile").when(F.col("expected") != F.col("actual"), "BadChecksum").otherwise("ok")
    return joined.select(*keys, "expected", "actual", status.alias("status"))


def manifest_outcome(manifest: DataFrame, files: DataFrame, nonfatal: Column) -> DataFrame:
    """(volume, outcome, failed): fail on a core mismatch, warning on others only, else pass."""
    joined = manifest.select("volume", "file", F.col("md5sum").alias("expected")).join(files.select("volume", "file", F.col("md5sum").alias("actual")), ["volume", "file"], "left")
    bad = ~F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))
    severity = F.when(bad & ~nonfatal, 2).when(bad, 1).otherwise(0)
    rolled = joined.groupBy("volume").agg(F.max(severity).alias("severity"), F.count_if(bad).alias("failed"))
    return rolled.select("volume", F.when(F.col("severity") == 2, "fail").when(F.col("severity") == 1, "warning").otherwise("pass").alias("outcome"), "failed")


def text_status(text: Column) -> Column:
    """BadUTF for other control characters than TAB and LF (CR is one), else ok."""
    return F.when(text.rlike("[\\x00-\\x08\\x0B-\\x1F]"), "BadUTF").otherwise("ok")


def bytes_status(content: Column) -> Column:
    """The same for bytes, which must be UTF-8 first."""
    return F.when(~F.is_valid_utf8(content.cast("string")), "BadUTF").otherwise(text_status(F.try_validate_utf8(content.cast("string"))))


def deleted_pages(pages: DataFrame, files: DataFrame) -> DataFrame:
    """What becomes of each page of the scan data: ok, keep, unlink or error, by presence and whether it may be missing."""
    present = files.select("volume", "page").distinct().withColumn("present", F.lit(1))
    joined = pages.join(present, ["volume", "page"], "left")
    may = (F.col("page_type") == "Delete") | (F.col("in_access") == "false")
    here = F.col("present").isNotNull()
    return joined.select("volume", "page", F.when(here & may, "unlink").when(here, "keep").when(may, "ok").otherwise("error").alias("action"))


def merge_events(events: DataFrame) -> DataFrame:
    """One event per id: those of later origin win, of one origin the latest."""
    last = Window.partitionBy("volume", "eventid").orderBy(F.desc("origin"), F.desc("date"), F.desc("event_id"))
    return events.withColumn("_at", F.row_number().over(last)).filter("_at = 1").drop("_at")


def missing_events(events: DataFrame, required: list[str]) -> DataFrame:
    """(volume, missing): required event types that a volume lacks, sorted."""
    seen = events.groupBy("volume").agg(F.collect_set("eventtype").alias("seen"))
    return seen.select("volume", F.array_join(F.array_sort(F.array_except(F.array(*map(F.lit, required)), "seen")), ",").alias("missing"))
