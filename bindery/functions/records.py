"""Repairs of catalogue records and image headers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import dpi, iso_date, tiff_date

ANY = "[0-9A-Za-z ]"
#: Positions of a MARC leader: (start, length, what is allowed, what else becomes).
LEADER = (
    (0, 5, "[0-9 ]{5}", "     "), (5, 1, ANY, " "), (6, 1, ".", None), (7, 1, ANY, " "), (8, 1, ANY, " "), (9, 1, ".", None), (10, 1, "[2 ]", " "), (11, 1, "[2 ]", " "),
    (12, 5, "[0-9 ]{5}", "     "), (17, 1, ANY, "u"), (18, 1, ANY, "u"), (19, 1, ANY, " "), (20, 4, "(4500|    )", "    "),
)


def marc_leader(leader: Column) -> Column:
    """A leader of 24 characters with each position made valid; ^ is a blank. A status of a without type is a type without status."""
    text = F.replace(leader, F.lit("^"), F.lit(" "))
    text = F.when(F.substring(text, 6, 2) == "a ", F.concat(F.substring(text, 1, 5), F.lit(" a"), F.substring(text, 8, 17))).otherwise(text)
    parts = []
    for start, size, allowed, instead in LEADER:
        part = F.substring(text, start + 1, size)
        parts.append(part if instead is None else F.when(part.rlike(f"^{allowed}$"), part).otherwise(instead))
    return F.concat(*parts)


def marc_fields(fields: Column) -> Column:
    """Data fields (tag, ind1, ind2, subfields) without local tags and empty ones, their indicators made valid."""
    indicator = lambda v: F.when(v.rlike("^[0-9a-z ]$"), v).otherwise(" ")
    kept = F.filter(fields, lambda f: ~f["tag"].rlike("^[A-Z]{3}$") & (F.size(f["subfields"]) > 0))
    return F.transform(kept, lambda f: F.struct(f["tag"].alias("tag"), indicator(f["ind1"]).alias("ind1"), indicator(f["ind2"]).alias("ind2"), f["subfields"].alias("subfields")))


def control_fields(fields: Column) -> Column:
    """Control fields whose tag is two digits and a letter or digit."""
    return F.filter(fields, lambda f: f["tag"].rlike("^[0-9]{2}[A-Z0-9]$"))


def header_dates(tiff: Column, xmp: Column, has_xmp: Column, default: Column) -> Column:
    """(tiff, xmp) dates of an image: one fills in for the other, the default for both or where they disagree.

    The dates agree when the XMP date begins with the TIFF date in ISO form.
    """
    t, x = tiff_date(tiff), iso_date(xmp)
    as_iso = lambda v: F.regexp_replace(v, r"^(\d{4}):(\d\d):(\d\d) ", "$1-$2-$3T")
    as_tiff = lambda v: F.regexp_replace(v, r"^(\d{4})-(\d\d)-(\d\d)T(\d\d:\d\d:\d\d).*", "$1:$2:$3 $4")
    one = F.coalesce(t, as_tiff(x), as_tiff(default))
    other = F.coalesce(x, as_iso(t), default)
    differ = has_xmp & ~other.startswith(as_iso(one))
    return F.struct(F.when(differ, as_tiff(default)).otherwise(one).alias("tiff"), F.when(has_xmp, F.when(differ, default).otherwise(other)).alias("xmp"))


def header_resolution(old: Column, old_unit: Column, forced: Column, offered: Column) -> Column:
    """The XMP resolution to write: the forced one, the offered one where none was there or it is below 100 dpi, else the old."""
    nonsense = F.coalesce(dpi(old, old_unit) < 100, F.lit(False))
    known = F.coalesce(forced, offered)
    return F.when(known.isNotNull() & (forced.isNotNull() | nonsense | old.isNull()), known).otherwise(old)


def png_resolution(pixels: Column, unit: Column) -> Column:
    """Dots per inch from pixels per unit, metres or inches."""
    return F.round(F.when(unit == "meters", pixels * 0.0254).otherwise(pixels)).cast("long")


def scan_time(log_end: Column, scan_date: Column, page_time: Column, modified: Column) -> Column:
    """The time of a scan: the first of four sources that is a time of 14 digits, as ISO 8601; hour 24 is hour 00."""
    form = r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$"
    given = [F.when(c.rlike(form), c) for c in (log_end, scan_date, page_time)]
    first = F.coalesce(*given, F.date_format(modified, "yyyyMMddHHmmss"))
    return F.regexp_replace(F.regexp_replace(first, form, "$1-$2-$3T$4:$5:$6Z"), "T24:", "T00:")


def page_file(name: Column, ext: str) -> Column:
    """The page's file name with eight digits, from one that ends in four."""
    return F.concat(F.lpad(F.regexp_extract(name, rf"(\d{{4}})\.{ext}$", 1), 8, "0"), F.lit(f".{ext}"))


def triage(message: Column, by_first: list[str], by_second: list[str]) -> Column:
    """Which tool can repair what a message tells, by its beginning; the first list goes first, anything else is fatal."""
    begins = lambda heads: F.greatest(*(message.startswith(h) for h in [*heads, heads[0]]))
    return F.when(begins(by_first), "first").when(begins(by_second), "second").otherwise("fatal")
