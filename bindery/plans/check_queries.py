"""Queries over checks of single values and fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks as c
from ..functions import records, scalars
from ..operators import audit, package, queueing, telemetry
from .registry import Tables, query


def pick(n, *values: str | None):
    """The value at n modulo their number."""
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


@query("time_checks", """
  select event_id, case event_id % 5 when 0 then 'ok' when 1 then 'ok' when 2 then 'NotEqualValues' when 3 then 'BadValue' else 'BadValue' end as status from events""")  # fmt: skip
def time_checks(t: Tables) -> DataFrame:
    n = F.col("event_id")
    text = pick(n, " 2024-01-02T03:04:05Z ", "2024-01-02T03:04:05+05:00", "2024-01-02T03:04:06", "2024-01-02", None)
    return t.events.select("event_id", c.time_status(text, F.lit("2024-01-02T03:04:05")).alias("status")).na.fill("BadValue")


@query("reading_orders", """
  select o_orderkey, case o_orderkey % 3 when 0 then 'left-to-right' when 1 then 'right-to-left' end as reading, case o_orderkey % 6 when 0 then 'ok' when 1 then 'ok' when 3 then 'MissingField' when 4 then 'MissingField' when 2 then 'MissingField' else 'ok' end as status from orders""")  # fmt: skip
def reading_orders(t: Tables) -> DataFrame:
    n = F.col("o_orderkey")
    reading = c.reading_order(pick(n, "lr", "rl", "xx"))
    scanning = F.when(n % 6 < 3, F.lit("left-to-right"))
    return t.orders.select("o_orderkey", reading.alias("reading"), c.order_status(scanning, reading).alias("status"))


@query("contributors", "select s_suppkey, case when s_suppkey % 3 = 0 then 'Internet Archive' else s_name end as contributor from supplier")
def contributors(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    by = c.contributor(pick(n, "scan@archive.org", "scan@example.org", None), pick(n, None, "x@archive.org", "x@example.org"), F.col("s_name"), "Internet Archive")
    return t.supplier.select("s_suppkey", by.alias("contributor"))


@query("file_times", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as zip_date from orders")
def file_times(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", c.file_time(F.col("o_orderdate")).alias("zip_date"))


@query("header_rules", """
  select p_partkey, case when p_partkey % 2 = 0 then p_brand when p_partkey % 3 = 0 then p_type end as artist, case when p_partkey % 5 = 0 then 'scanner' else 'unknown' end as make, 'forced' as model from part""")  # fmt: skip
def header_rules(t: Tables) -> DataFrame:
    """A field of its own, or copied from another; set where nothing is; forced."""
    n = F.col("p_partkey")
    old = F.map_filter(F.create_map(F.lit("artist"), F.when(n % 2 == 0, F.col("p_brand")), F.lit("creator"), F.when(n % 3 == 0, F.col("p_type")), F.lit("make"), F.when(n % 5 == 0, F.lit("scanner")), F.lit("model"), F.lit("old")), lambda k, v: v.isNotNull())
    new = c.header_fields(old, {"artist": "creator"}, {"make": F.lit("unknown")}, {"model": F.lit("forced")})
    return t.part.select("p_partkey", *(F.try_element_at(new, F.lit(k)).alias(k) for k in ("artist", "make", "model")))


@query("prevalidated", "select p_partkey, p_size <= 2 as sized, p_partkey % 4 > 0 as present from part")
def prevalidated(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", c.prevalidated(F.col("p_size").cast("string"), "1", "2").alias("sized"), c.prevalidated(F.when(F.col("p_partkey") % 4 > 0, F.col("p_brand"))).alias("present"))


@query("tiff_classes", "select l_orderkey, l_linenumber, case l_linenumber % 4 when 1 then 'grey' when 3 then 'rgb' end as kind from lineitem")
def tiff_classes(t: Tables) -> DataFrame:
    k = F.col("l_linenumber") % 4
    kind = c.tiff_class(F.when(k == 1, 1).otherwise(3), F.when(k == 1, "8").when(k == 3, "8 8 8").otherwise("16 16 16"))
    return t.lineitem.select("l_orderkey", "l_linenumber", kind.alias("kind"))


@query("tiff_resolutions", """
  select l_orderkey, l_linenumber, case l_linenumber % 6 when 0 then 'MissingField' when 1 then 'ok' when 2 then 'ok' when 3 then 'NotEqualValues' when 4 then 'BadValue' else 'ok' end as listed,
    case l_linenumber % 6 when 0 then 'MissingField' when 3 then 'NotEqualValues' when 4 then 'BadValue' else 'ok' end as least, case l_linenumber % 6 when 0 then 'MissingField' when 3 then 'NotEqualValues' else 'ok' end as present from lineitem""")  # fmt: skip
def tiff_resolutions(t: Tables) -> DataFrame:
    n = F.col("l_linenumber")
    x, y = pick(n, None, "600", "6000000/10000", "600", "300/1", "400"), pick(n, "600", "600", "600/1", "400/1", "300", "400")
    return t.lineitem.select("l_orderkey", "l_linenumber", c.resolution_status(x, y, allowed=[400, 600]).alias("listed"), c.resolution_status(x, y, least=400).alias("least"), c.resolution_status(x, y).alias("present"))


@query("error_remedies", """
  select event_id, case when event_id % 3 = 0 or event_id % 4 = 0 then 'Nonremediable' when event_id % 3 = 2 or event_id % 4 > 1 then 'Possibly remediable' else 'Remediable' end as remedy from events""")  # fmt: skip
def error_remedies(t: Tables) -> DataFrame:
    n = F.col("event_id")
    both = c.remedy((n % 3).cast("int"), F.least(n % 4, F.lit(2)).cast("int"))
    return t.events.select("event_id", telemetry.remediable(both).alias("remedy"))


@query("capture_records", "select o_orderkey, case when o_orderkey % 4 = 0 then 'none' when o_orderkey % 4 = 3 then 'ok' else 'MissingField' end as status from orders")
def capture_records(t: Tables) -> DataFrame:
    """A compression event has date, agent and tool, or none of them."""
    k = F.col("o_orderkey") % 4
    return t.orders.select("o_orderkey", c.complete(F.when(k > 0, "2024"), F.when(k > 1, "agent"), F.when(k > 2, "tool")).alias("status"))


@query("source_records", """
  select volume, case when n = 1 then name end as name, case when n > 1 then 'BadFile' when n = 0 then 'none' else 'ok' end as status
  from (select volume, count(*) filter (file like '%1.xml') as n, min(file) filter (file like '%1.xml') as name from volume_files group by volume)""", "volume_files")  # fmt: skip
def source_records(t: Tables) -> DataFrame:
    names = t.volume_files.groupBy("volume").agg(F.collect_list("file").alias("names"))
    return names.select("volume", c.one_match(F.col("names"), r"1\.xml$").alias("m")).select("volume", "m.name", "m.status")


@query("first_marc", """
  select user_id, min(event_id) filter (event_type = 'signup') as record, case count(*) filter (event_type = 'signup') when 0 then 'BadField' when 1 then 'ok' else 'warning' end as status from events group by user_id""")  # fmt: skip
def first_marc(t: Tables) -> DataFrame:
    records_ = F.array_sort(F.collect_list(F.when(F.col("event_type") == "signup", F.col("event_id"))))
    rows = t.events.groupBy("user_id").agg(records_.alias("r"))
    return rows.select("user_id", c.first_record(F.col("r")).alias("f")).select("user_id", "f.record", "f.status")


@query("stage_defaults", "select event_id, event_id % 3 = 1 and event_id % 2 = 0 as success from events")
def stage_defaults(t: Tables) -> DataFrame:
    n = F.col("event_id")
    done = F.when(n % 3 > 0, n % 3 == 1)
    return t.events.select("event_id", c.stage_succeeded(done, n % 2).alias("success"))


@query("recency_skips", """
  select o_orderkey, o_orderdate >= timestamp '1999-12-30' or (o_orderkey % 2 = 0 and o_orderdate >= timestamp '1998-12-30') as skipped, o_orderdate >= timestamp '1999-12-31' as fresh from orders""")  # fmt: skip
def recency_skips(t: Tables) -> DataFrame:
    now, at = F.lit("2000-01-01").cast("timestamp"), F.col("o_orderdate")
    old = F.when(F.col("o_orderkey") % 2 == 0, at + F.make_dt_interval(F.lit(365)))
    return t.orders.select("o_orderkey", c.too_recent(now, at, old).alias("skipped"), audit.recent(at, now, 1).alias("fresh"))


@query("random_object", "select 1 as n, true as eligible")
def random_object(t: Tables) -> DataFrame:
    """One object at random, and whether it may be taken."""
    picked = audit.sample(t.feed_backups, 7, ["object_no", "object_part"])
    return picked.agg(F.count("*").cast("int").alias("n"), F.bool_and(F.col("deleted").isNull() & F.col("saved_md5sum").isNotNull()).alias("eligible"))


@query("sampled_objects", """
  select object_no, object_part, saved_md5sum from feed_backups where deleted is null and saved_md5sum is not null
  order by md5(concat('11:', cast(object_no as varchar), ':', cast(object_part as varchar), ':', saved_md5sum)), object_no, object_part, saved_md5sum limit 50""", "feed_backups")  # fmt: skip
def sampled_objects(t: Tables) -> DataFrame:
    """Fifty objects at random, the same in every run."""
    return audit.sample(t.feed_backups, 11, ["object_no", "object_part", "saved_md5sum"], 50).select("object_no", "object_part", "saved_md5sum")


@query("clean_texts", "select conv_id, turn, length(text) + 2 as size, replace(text, chr(10), '') as flat from conversations")
def clean_texts(t: Tables) -> DataFrame:
    """Line ends of two characters, one line before a form feed, and one at the end."""
    dirty = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\f\n"), F.lit("\r\n"))
    text = scalars.clean_lines(dirty)
    return t.conversations.select("conv_id", "turn", F.length(text).cast("long").alias("size"), F.replace(text, F.lit("\n"), F.lit("")).alias("flat"))


@query("marc_data_fields", """
  select p_partkey, case when p_size % 2 = 0 then '1' else ' ' end as ind1, case when p_size % 3 = 0 then 'a' else ' ' end as ind2, p_brand as a from part where p_partkey % 5 > 0 and p_partkey % 7 > 0""")  # fmt: skip
def marc_data_fields(t: Tables) -> DataFrame:
    """Fields with a local tag or without content go; an indicator that may not be becomes a blank."""
    n = F.col("p_partkey")
    subfields = F.when(n % 7 > 0, F.array(F.struct(F.lit("a").alias("code"), F.col("p_brand").alias("value")))).otherwise(F.array())
    field = F.struct(F.when(n % 5 == 0, "CAT").otherwise("245").alias("tag"), F.when(F.col("p_size") % 2 == 0, "1").otherwise("^").alias("ind1"), F.when(F.col("p_size") % 3 == 0, "a").otherwise("Z").alias("ind2"), subfields.alias("subfields"))
    kept = t.part.select("p_partkey", F.inline(records.marc_fields(F.array(field))))
    return kept.select("p_partkey", "ind1", "ind2", F.col("subfields")[0]["value"].alias("a"))


@query("marc_control_fields", "select p_partkey, case p_partkey % 3 when 0 then '001' else '00A' end as tag from part where p_partkey % 3 < 2")
def marc_control_fields(t: Tables) -> DataFrame:
    field = F.struct(pick(F.col("p_partkey"), "001", "00A", "FMT").alias("tag"))
    return t.part.select("p_partkey", F.inline(records.control_fields(F.array(field))))


@query("delivery_places", "select event_id % 7 as batch, event_id, row_number() over (partition by event_id % 7 order by user_id % 3 desc, event_id) as place from events")
def delivery_places(t: Tables) -> DataFrame:
    """Within a batch higher priority goes first, then first come."""
    rows = t.events.select((F.col("event_id") % 7).alias("batch"), "event_id", (F.col("user_id") % 3).alias("priority"), F.col("event_id").alias("arrival"))
    return queueing.delivery_places(rows, "batch").select("batch", "event_id", "place")


@query("epub_names", "select s_suppkey, s_suppkey % 4 in (0, 1) as valid from supplier")
def epub_names(t: Tables) -> DataFrame:
    name = F.when(F.col("s_suppkey") % 4 == 3, "ark+=1.epub").otherwise(pick(F.col("s_suppkey"), "checksum.md5", "00000001.txt", "notes.doc", "meta.yml"))
    return t.supplier.select("s_suppkey", name.rlike(package.VALID_NAMES["epub"]).alias("valid"))
