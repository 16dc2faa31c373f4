"""Readers for the file forms of the ingest domain: listings, checksum files, id lists, messages, metadata, HTML."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The pairtree escapes of three characters in path names.
PAIRTREE = ("/:.", "=+,")


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, modified) of the files under path, contents unread."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def ignored(name: Column) -> Column:
    """Files that no listing shows; their names are fixed values."""
    return name.rlike(r"^\.+$") | (name == ".DS_Store") | F.lower(name).rlike(r"^thumbs\.db$")


def object_folders(files: DataFrame) -> DataFrame:
    """Repository objects: one row per folder with sdr partition, namespace, objid and sorted file names; staging is skipped."""
    parts = F.split("path", "/")
    named = files.select(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("folder"), F.element_at(parts, -1).alias("file"))
    kept = named.filter(~F.col("folder").contains("obj/.tmp") & (F.col("file") != "pairtree_prefix") & ~ignored(F.col("file")))
    grouped = kept.groupBy("folder").agg(F.array_sort(F.collect_set("file")).alias("files"))
    return grouped.select(
        "folder", F.nullif(F.regexp_extract("folder", r"sdr(\d+)", 1), F.lit("")).cast("int").alias("sdr_partition"),
        F.regexp_extract("folder", r"/obj/([^/]+)/pairtree_root/", 1).alias("namespace"), pairtree_decode(F.element_at(F.split("folder", "/"), -1)).alias("id"), "files",
    )


def pairtree_encode(objid: Column) -> Column:
    return F.translate(objid, *PAIRTREE)


def pairtree_decode(name: Column) -> Column:
    """The id of a path name; `^hh` escapes are single bytes below 128, any other use of ^ is an error and gives null."""
    plain = F.translate(name, *reversed(PAIRTREE))
    parts = F.split(plain, r"\^")
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    ok = F.forall(tail, lambda p: p.rlike("^[0-7][0-9a-f]"))
    decoded = F.aggregate(tail, F.element_at(parts, 1), lambda text, p: F.concat(text, F.decode(F.unhex(F.substring(p, 1, 2)), "UTF-8"), F.substring(p, 3, 1 << 20)))
    return F.when(ok, decoded)


def versioned_objects(files: DataFrame) -> DataFrame:
    """Backup files <base>/<namespace>/<prefix>/<id>.<version>.<ext>, one row per version with its set of files."""
    parts = F.split("path", "/")
    name = F.split(F.element_at(parts, -1), r"\.", 3)
    rows = files.select(F.element_at(parts, -3).alias("namespace"), pairtree_decode(name[0]).alias("id"), name[1].alias("version"), F.get(name, F.lit(2)).alias("ext"))
    return rows.groupBy("namespace", "id", "version").agg(F.array_sort(F.collect_set("ext")).alias("files"))


def store_objects(keys: DataFrame) -> DataFrame:
    """Object-store keys <namespace>.<id>.<version>.<ext>, one row per version with its set of files."""
    name = F.split("key", r"\.", 4)
    rows = keys.select(name[0].alias("namespace"), pairtree_decode(name[1]).alias("id"), name[2].alias("version"), F.get(name, F.lit(3)).alias("ext"))
    return rows.groupBy("namespace", "id", "version").agg(F.array_sort(F.collect_set("ext")).alias("files"))


def checksum_lines(lines: DataFrame) -> DataFrame:
    """(volume, file, md5sum) from the lines (volume, line_no, line) of checksum files.

    Byte-order marks, carriage returns, folders and trailing blanks go; case is
    folded; malformed lines are skipped; the last line of a name wins.
    """
    text = F.regexp_replace(F.regexp_replace("line", "^\\x{FEFF}", ""), r"[\r\n]+$", "")
    md5 = F.regexp_extract(text, r"^([a-fA-F0-9]{32})(\s+\*?)(\S.*)", 1)
    name = F.lower(F.rtrim(F.regexp_extract(F.regexp_extract(text, r"^([a-fA-F0-9]{32})(\s+\*?)(\S.*)", 3), r"([^/\\]*)$", 1)))
    rows = lines.select("volume", "line_no", name.alias("file"), F.lower(md5).alias("md5sum")).filter((F.col("md5sum") != "") & ~ignored(F.col("file")) & (F.col("file") != ".ds_store"))
    return rows.groupBy("volume", "file").agg(F.max_by("md5sum", "line_no").alias("md5sum"))


def id_list(lines: DataFrame, dotted: bool = False, namespace: str | None = None, pkg_type: str | None = None) -> DataFrame:
    """(pkg_type, namespace, id) from lines of ids: dotted `namespace.id`, or columns read from the right."""
    text = F.trim("line")
    if dotted:
        m = r"^([^.\s]*)\.(\S*)$"
        return lines.filter(text.rlike(m)).select(F.lit(pkg_type).alias("pkg_type"), F.regexp_extract(text, m, 1).alias("namespace"), F.regexp_extract(text, m, 2).alias("id"))
    words = F.split(text, r"\s+")
    return lines.filter(text != "").select(F.coalesce(F.try_element_at(words, F.lit(-3)), F.lit(pkg_type)).alias("pkg_type"), F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit(namespace)).alias("namespace"), F.element_at(words, -1).alias("id"))


def messages(bodies: Column) -> Column:
    return F.from_json(bodies, "namespace string, id string, pkg_type string, status string")


def valid_message(bodies: Column) -> Column:
    """Whether all four fields are there and true in the sense that neither '' nor '0' is."""
    parsed = messages(bodies)
    return F.coalesce(F.forall(F.array(*(parsed[c] for c in ("namespace", "id", "pkg_type", "status"))), lambda v: F.coalesce((v != "") & (v != "0"), F.lit(False))), F.lit(False))


def links(html: Column) -> Column:
    """href of every a element, in order."""
    return F.regexp_extract_all(html, F.lit('<a[^>]*href="([^"]*)"'), 1)


def first_link(all_links: Column, suffix: str, but_not: str | None = None) -> Column:
    """The first link that ends in suffix, and not in but_not; null without one."""
    return F.get(F.filter(all_links, lambda x: x.endswith(suffix) & (~x.endswith(but_not) if but_not else F.lit(True))), F.lit(0))


def yaml_metadata(files: DataFrame) -> DataFrame:
    """(volume, metadata, error) from YAML texts (volume, text): scalar keys as strings, dates in ISO form."""
    def parse(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        import yaml

        for pdf in pdfs:
            rows = []
            for volume, text in zip(pdf["volume"], pdf["text"]):
                if text is None:
                    rows.append((volume, None, "MissingFile"))
                    continue
                try:
                    loaded = yaml.load(text, yaml.BaseLoader)
                    flat = {k: v for k, v in loaded.items() if isinstance(v, str)}
                except (yaml.YAMLError, AttributeError):
                    rows.append((volume, None, "BadFile"))
                    continue
                for k in flat:
                    if "date" in k:
                        flat[k] = re.sub(r"^(\d{4}).(\d\d).(\d\d).(\d\d).(\d\d).(\d\d)", r"\1-\2-\3T\4:\5:\6", flat[k])
                rows.append((volume, flat, None))
            yield pd.DataFrame(rows, columns=["volume", "metadata", "error"])

    return files.select("volume", "text").mapInPandas(parse, "volume string, metadata map<string,string>, error string")


def zip_source(files: DataFrame) -> DataFrame:
    """(volume, status) of zips (volume, content): OK, NO_SOURCE_METS or MULTIPLE, by members <id>/<word>_<id>.xml.

    CANT_UNZIP where content is null, no zip or cut short; members may be encrypted, only their names are read.
    """
    def scan(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import re
        import zipfile

        for pdf in pdfs:
            rows = []
            for volume, content in zip(pdf["volume"], pdf["content"]):
                try:
                    names = zipfile.ZipFile(io.BytesIO(content)).namelist()
                except zipfile.BadZipFile:
                    rows.append((volume, "CANT_UNZIP"))
                    continue
                n = sum(bool(re.search(rf"^{re.escape(volume)}/\w+_{re.escape(volume)}\.xml$", x)) for x in names)
                rows.append((volume, "OK" if n == 1 else "MULTIPLE" if n else "NO_SOURCE_METS"))
            yield pd.DataFrame(rows, columns=["volume", "status"])

    return files.select("volume", "content").mapInPandas(scan, "volume string, status string")
