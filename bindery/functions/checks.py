"""Checks and choices about a volume's metadata, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A date, a time of day to the second, and at most one offset: Z, or hours and minutes with their sign.
DATE, CLOCK, OFFSET = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}:[0-9]{2}", r"Z|[+-][0-9]{2}:[0-9]{2}"
TIME = rf"^({DATE}T{CLOCK})(?:{OFFSET})?\z"
#: Reading orders by their short names.
ORDERS = {"lr": "left-to-right", "rl": "right-to-left"}


def time_of(text: Column) -> Column:
    """The date and time that a header's text has, trimmed; null for another form."""
    clean = F.trim(text)
    return F.when(clean.rlike(TIME), F.regexp_extract(clean, TIME, 1))


def time_status(text: Column, earlier: Column) -> Column:
    """BadValue for another form, NotEqualValues where an earlier header of the file differs."""
    found = time_of(text)
    return F.when(found.isNull(), "BadValue").when(earlier.isNotNull() & (time_of(earlier) != found), "NotEqualValues").otherwise("ok")


def reading_order(short: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in ORDERS.items() for x in pair)), short)


def order_status(scanning: Column, reading: Column) -> Column:
    """Scanning and reading order are given both or neither, each by a known name."""
    known = [c.isin(*ORDERS.values()) for c in (scanning, reading)]
    return F.when(scanning.isNull() & reading.isNull(), "ok").when(scanning.isNull() | reading.isNull(), "MissingField").when(known[0] & known[1], "ok").otherwise("BadValue")


def contributor(uploader: Column, operator: Column, named: Column, otherwise: str, host: str = "archive.org") -> Column:
    """The named contributor, if someone from elsewhere than the host scanned the item."""
    outside = lambda c: F.coalesce(~c.endswith(host), F.lit(False))
    return F.when(outside(uploader) | outside(operator), named).otherwise(otherwise)


def file_time(modified: Column) -> Column:
    """A file's time as the tables have it."""
    return F.date_format(modified, "yyyy-MM-dd HH:mm:ss")


def header_fields(old: Column, copied: dict[str, str], unset: dict[str, Column], forced: dict[str, Column]) -> Column:
    """Header fields to write, from a map of the old ones.

    copied names a field's source, taken where it is there and the field is not;
    unset gives values for fields still without one; forced ones always win.
    """
    now: dict[str, Column] = {}
    for name in dict.fromkeys([*copied, *unset, *forced]):
        own = F.try_element_at(old, F.lit(name))
        choices = [own]
        if name in copied:
            choices.append(F.try_element_at(old, F.lit(copied[name])))
        if name in unset:
            choices.append(unset[name])
        now[name] = F.coalesce(forced[name], *choices) if name in forced else F.coalesce(*choices)
    pairs = F.map_from_arrays(F.array(*map(F.lit, now)), F.array(*(v.cast("string") for v in now.values())))
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def prevalidated(actual: Column, *expected: str) -> Column:
    """There, and one of the expected values if any are."""
    return F.coalesce(actual.isin(*expected) if expected else actual.isNotNull(), F.lit(False))


def tiff_class(samples: Column, bits: Column) -> Column:
    """rgb: three samples of eight bits; grey: one; null otherwise."""
    return F.when((samples == 3) & (bits == "8 8 8"), "rgb").when((samples == 1) & (bits == "8"), "grey")


def rational(text: Column) -> Column:
    """A resolution written as a number or as numerator/denominator."""
    parts = F.split(text, "/")
    return F.try_divide(parts[0].try_cast("double"), F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(1.0)))


def resolution_status(x: Column, y: Column, allowed: list[int] | None = None, least: int | None = None) -> Column:
    """Of two rational resolutions: there, equal, one of the allowed ones or no less than the least."""
    a, b = rational(x), rational(y)
    good = a.isin(*map(float, allowed)) if allowed else a >= least if least else F.lit(True)
    return F.when(a.isNull() | b.isNull(), "MissingField").when(a != b, "NotEqualValues").when(good, "ok").otherwise("BadValue")


def remedy(first: Column, second: Column) -> Column:
    """How an error over two fields can be mended: no (0) if either can't, possibly (2) if either may, else yes (1)."""
    return F.when((first == 0) | (second == 0), 0).when((first == 2) | (second == 2), 2).otherwise(1)


def complete(*parts: Column) -> Column:
    """ok where all parts of an optional record are there, none where none is, else MissingField."""
    given = sum(p.isNotNull().cast("int") for p in parts)
    return F.when(given == 0, "none").when(given == len(parts), "ok").otherwise("MissingField")


def one_match(names: Column, pattern: str) -> Column:
    """(name, status) of the only name that matches: at most one may."""
    found = F.filter(names, lambda x: x.rlike(pattern))
    return F.struct(F.when(F.size(found) == 1, found[0]).alias("name"), F.when(F.size(found) > 1, "BadFile").when(F.size(found) == 0, "none").otherwise("ok").alias("status"))


def first_record(records: Column) -> Column:
    """(record, status): the first of several, with a warning; BadField without any."""
    n = F.size(records)
    return F.struct(F.get(records, F.lit(0)).alias("record"), F.when(n < 1, "BadField").when(n > 1, "warning").otherwise("ok").alias("status"))


def stage_succeeded(done: Column, errors: Column) -> Column:
    """A stage that never said it was done has failed."""
    return F.coalesce(done & (errors == 0), F.lit(False))


def too_recent(now: Column, modified: Column, old_changed: Column, days: int = 2) -> Column:
    """Objects that change now, or whose old copy was put aside lately, are audited another time."""
    limit = now - F.make_dt_interval(F.lit(days))
    return F.coalesce(modified >= limit, F.lit(False)) | F.coalesce(old_changed >= limit, F.lit(False))
