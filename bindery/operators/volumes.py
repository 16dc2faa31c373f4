"""Choices and checks about whole volumes: where their parts come from, which ids count, what is kept and put back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import event_uuid

#: The box id of XMP in JP2 images, as signed bytes.
XMP_BOX = (-66, 122, -49, -53, -105, -87, 66, -24, -100, 113, -103, -108, -111, -29, -81, -84)


def tiff_xmp(packets: Column) -> Column:
    """(xmp, status) of a TIFF's XMP packets: none is skipped, several are an error."""
    n = F.coalesce(F.size(packets), F.lit(0))
    return F.struct(F.when(n == 1, F.get(packets, F.lit(0))).alias("xmp"), F.when(n < 1, "skipped").when(n > 1, "BadField").otherwise("ok").alias("status"))


def jp2_xmp(boxes: Column) -> Column:
    """(xmp, status) of a JP2's boxes (uuid: signed bytes, data: binary): exactly one must be XMP."""
    mine = F.filter(boxes, lambda b: b["uuid"] == F.array(*map(F.lit, XMP_BOX)))
    return F.struct(F.when(F.size(mine) == 1, F.decode(mine[0]["data"], "UTF-8")).alias("xmp"), F.when(F.size(mine) == 1, "ok").otherwise("BadField").alias("status"))


def xmp_value(xmp: Column, name: str) -> Column:
    """(value, status) of one element of an XMP packet: BadField where it can't be parsed, MissingField without it."""
    read = F.from_xml(xmp, f"`{name}` string, broken string", {"columnNameOfCorruptRecord": "broken"})
    status = F.when(read.isNull() | read["broken"].isNotNull(), "BadField").when(read[name].isNull(), "MissingField").otherwise("ok")
    return F.struct(F.when(read["broken"].isNull(), read[name]).alias("value"), status.alias("status"))


def migrated_events(events: DataFrame, renames: DataFrame) -> DataFrame:
    """Events under their present types, with new ids; renames (eventtype, new_type) may give one several, others keep theirs."""
    joined = events.join(renames, "eventtype", "left").withColumn("new_type", F.coalesce("new_type", "eventtype"))
    return joined.withColumn("eventid", event_uuid(F.col("namespace"), F.col("id"), F.col("new_type"), F.col("date"))).drop("eventtype").withColumnRenamed("new_type", "eventtype")


def complete_events(events: DataFrame, required: list[str]) -> DataFrame:
    """Events with all required fields, the last of each id by time."""
    there = events.filter(F.forall(F.array(*(F.col(c).isNotNull() for c in required)), lambda x: x))
    last = Window.partitionBy("volume", "eventid").orderBy(F.desc("date"), F.desc("event_id"))
    return there.withColumn("_at", F.row_number().over(last)).filter("_at = 1").drop("_at")


def id_status(found: Column, objid: Column) -> Column:
    """Whether a record names the volume that it came with."""
    return F.when(found.isNull(), "MissingField").when(found != objid, "NotEqualValues").otherwise("ok")


def preferred(choices: dict[str, Column]) -> Column:
    """(source, value): the first of several sources that has one."""
    named = F.array_compact(F.array(*(F.when(v.isNotNull(), F.struct(F.lit(k).alias("source"), v.cast("string").alias("value"))) for k, v in choices.items())))
    return F.get(named, F.lit(0))


def put_back(current: DataFrame, old: DataFrame, moved: DataFrame, keys: list[str]) -> DataFrame:
    """The state after a failed run: rows that this run had put aside return, all others stay as they are."""
    mine = moved.select(*keys).distinct()
    return current.join(mine, keys, "left_anti").unionByName(old.join(mine, keys, "left_semi"))


def zip_members(zips: DataFrame) -> DataFrame:
    """(volume, file, md5sum) of the members of zips (volume, content), names in lower case without folders; unreadable ones give a null file."""
    def scan(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import io
        import zipfile
        import zlib

        for pdf in pdfs:
            rows = []
            for volume, content in zip(pdf["volume"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        rows += [(volume, n.rpartition("/")[2].lower(), hashlib.md5(z.read(n)).hexdigest()) for n in z.namelist() if not n.endswith("/")]
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):  # no zip, cut short, damaged inside, or encrypted
                    rows.append((volume, None, None))
            yield pd.DataFrame(rows, columns=["volume", "file", "md5sum"])

    return zips.select("volume", "content").mapInPandas(scan, "volume string, file string, md5sum string")


def unpacked(zips: DataFrame, keep_case: bool = False) -> DataFrame:
    """(volume, file, size, md5sum, status) of what zips (volume, content) give.

    `ok` is a member that was read; `warning` one that is skipped because it is
    encrypted or of an unknown method, which the volume survives; `error` one that is
    damaged, or with a null file a volume that is no zip. Names come without folders,
    in lower case unless keep_case. A task holds one zip, and of a member one block.
    """
    def scan(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import io
        import zipfile
        import zlib

        def member(z: zipfile.ZipFile, name: zipfile.ZipInfo) -> tuple[int | None, str | None, str]:
            digest, size = hashlib.md5(), 0
            try:
                with z.open(name) as held:
                    while block := held.read(1 << 20):
                        digest.update(block)
                        size += len(block)
            except (NotImplementedError, RuntimeError):  # unknown method; encrypted
                return None, None, "warning"
            except (zipfile.BadZipFile, zlib.error, EOFError):
                return None, None, "error"
            return size, digest.hexdigest(), "ok"

        def framed(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["volume", "file", "size", "md5sum", "status"]).astype({"size": "Int64"})

        for pdf in pdfs:
            rows = []
            for volume, content in zip(pdf["volume"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        for info in z.infolist():
                            if not info.is_dir():
                                name = info.filename.rpartition("/")[2]
                                rows.append((volume, name if keep_case else name.lower(), *member(z, info)))
                except zipfile.BadZipFile:
                    rows.append((volume, None, None, None, "error"))
                if len(rows) >= 1000:  # members go on before the batch's last zip is read
                    yield framed(rows)
                    rows = []
            yield framed(rows)

    return zips.select("volume", "content").mapInPandas(scan, "volume string, file string, size long, md5sum string, status string")


def unpack_outcomes(zips: DataFrame, members: DataFrame) -> DataFrame:
    """(volume, status, n) for every volume: the worst status of its members and how many were read; a zip without any is `ok`."""
    worst = F.when(F.max(F.col("status") == "error"), "error").when(F.max(F.col("status") == "warning"), "warning").otherwise("ok")
    found = members.groupBy("volume").agg(worst.alias("status"), F.count_if(F.col("status") == "ok").alias("n"))
    return zips.select("volume").distinct().join(found, "volume", "left").select("volume", F.coalesce("status", F.lit("ok")).alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


def source_record(names: Column) -> Column:
    """The first XML file, by name, that is not a page's."""
    return F.get(F.array_sort(F.filter(names, lambda n: n.endswith(".xml") & ~n.rlike(r"^\d{8}\."))), F.lit(0))


def parted(volumes: DataFrame, validators: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) volumes by the validator of their namespace; a namespace without one takes any id."""
    ok = F.lit(True)
    for namespace, test in validators.items():
        ok = F.when(F.col("namespace") == namespace, F.coalesce(test, F.lit(False))).otherwise(ok)
    return volumes.filter(ok), volumes.filter(~ok)


def report_blocks(streams: DataFrame, tag: str = "repInfo") -> DataFrame:
    """(volume, file, xml): the reports of a tool's one output stream (volume, output), each of which names its file in uri."""
    block = F.explode(F.regexp_extract_all("output", F.lit(rf"(?s)(<{tag}[ >].*?</{tag}>)"), 1)).alias("xml")
    return streams.select("volume", block).select("volume", F.regexp_extract("xml", r'uri="([^"]*)"', 1).alias("file"), "xml")


REPORT = """_uri string, status string, messages array<struct<message array<struct<_VALUE string, _severity string>>>>, broken string"""


def read_reports(spark: SparkSession, path: str, tag: str = "repInfo") -> DataFrame:
    """One row per report of a tool's output files, however large: uri, status, errors (its messages of severity error) and xml.

    Files are read by byte ranges that end at a report's end tag, so that one output is
    shared by many tasks and no row holds more than one report. What stands before the
    first report and behind the last is left out.
    """
    ended = spark.read.option("lineSep", f"</{tag}>").text(path)
    begin = F.locate(f"<{tag}", F.col("value"))
    xml = ended.filter(begin > 0).select(F.concat(F.substring("value", begin, F.length("value")), F.lit(f"</{tag}>")).alias("xml"))
    read = xml.select("xml", F.from_xml("xml", REPORT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "ignoreNamespace": "true"}).alias("r"))
    messages = F.flatten(F.coalesce("r.messages.message", F.array().cast("array<array<struct<_VALUE:string,_severity:string>>>")))
    wrong = F.transform(F.filter(messages, lambda m: m["_severity"] == "error"), lambda m: m["_VALUE"])
    # a report that can't be parsed still says which file it is about
    uri = F.coalesce("r._uri", F.regexp_extract("xml", r'uri="([^"]*)"', 1))
    return read.select(uri.alias("uri"), F.when(F.col("r.broken").isNull(), F.col("r.status")).alias("status"), F.when(F.col("r.broken").isNull(), wrong).alias("errors"), "xml")


def report_outcomes(requested: DataFrame, reports: DataFrame) -> DataFrame:
    """Each file (uri) that was asked for or reported: ok, or MissingFile without a report, BadField with several, BadFile with one that can't be read, Unexpected if nobody asked."""
    counted = reports.groupBy("uri").agg(F.count("*").alias("n"), F.max("status").alias("status"))
    joined = requested.select("uri").distinct().withColumn("asked", F.lit(True)).join(counted, "uri", "full_outer")
    outcome = F.when(F.col("asked").isNull(), "Unexpected").when(F.col("n").isNull(), "MissingFile").when(F.col("n") > 1, "BadField").when(F.col("status").isNull(), "BadFile").otherwise("ok")
    return joined.select("uri", F.coalesce("n", F.lit(0)).alias("n"), "status", outcome.alias("outcome"))


def unreported(requested: DataFrame, reports: DataFrame) -> DataFrame:
    """Requested files (volume, file) that no report is about."""
    return requested.join(reports.select("volume", "file"), ["volume", "file"], "left_anti")


def history(log: DataFrame, keys: list[str]) -> DataFrame:
    """log with each row's place in its volume's history."""
    return log.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("logged_at", "event_id")))


def merged_exceptions(stored: Column, given: Column, replace: bool = False) -> Column:
    """A volume's exceptions, sorted and once each: the given ones, and the stored ones unless these are replaced."""
    own = F.coalesce(given, F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(own) if replace else F.array_union(own, F.coalesce(stored, F.array().cast("array<string>"))))


def store_key(namespace: Column, pairtree_id: Column, version: Column, ext: str = "zip") -> Column:
    """An object store's key of a version."""
    return F.concat_ws(".", namespace, pairtree_id, version, F.lit(ext))


def staging_path(base: Column, namespace: Column, pairtree_id: Column) -> Column:
    """Where a volume waits before its deposit."""
    return F.concat_ws("/", base, F.lit(".tmp"), F.concat_ws(".", namespace, pairtree_id))


def scan_resolution(recorded: Column, scandata: Column, item: Column) -> Column:
    """Dots per inch: as recorded, else of the scan data, else the item's, written with or without its unit."""
    return F.coalesce(recorded, scandata, F.regexp_replace(item, "ppi$", "").try_cast("int"))


def item_outcome(all_links: Column, core: dict[str, str], optional: dict[str, str]) -> Column:
    """fail where a core item has no link by its suffix, warning where an optional one has none, else pass."""
    lacks = lambda suffixes: F.exists(F.array(*map(F.lit, suffixes.values())), lambda s: ~F.exists(all_links, lambda x: x.endswith(s)))
    return F.when(lacks(core), "fail").when(lacks(optional), "warning").otherwise("pass")
