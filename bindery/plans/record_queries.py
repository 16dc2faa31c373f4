"""Queries over repairs of catalogue records and image headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from .registry import Tables, query

LEADERS = """case o_orderkey % 4 when 0 then concat(lpad(cast(o_orderkey % 100000 as string), 5, '0'), 'nam^a2200049^a^4500') when 1 then concat('x1y2z', 'a m a22', '00100', 'i  4500', '')
  when 2 then '00714cam a2200205#a 450#' else concat(lpad('', 5, ' '), '?am aX!12z45', '   4500') end"""


@query("marc_leaders", """
  with l as (select o_orderkey, lpad(cast(o_orderkey % 100000 as string), 5, '0') as n, o_orderkey % 4 as k from orders)
  select o_orderkey, case k when 0 then concat(n, 'nam a2200049 a 4500') when 1 then '      am a2200100i  4500' when 2 then '00714cam a2200205ua     ' else '      am a          4500' end as leader from l""")  # fmt: skip
def marc_leaders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", r.marc_leader(F.expr(LEADERS)).alias("leader"))


@query("image_dates", """
  select event_id, case event_id % 5 when 0 then '2024:01:02 03:04:05' when 1 then '2024:01:02 03:04:05' when 2 then '2023:05:06 07:08:09' else '2020:01:01 00:00:00' end as tiff,
    case event_id % 5 when 0 then '2024-01-02T03:04:05Z' when 1 then '2024-01-02T03:04:05' when 2 then '2023-05-06T07:08:09Z' when 3 then '2020-01-01T00:00:00Z' end as xmp from events""")  # fmt: skip
def image_dates(t: Tables) -> DataFrame:
    k = F.col("event_id") % 5
    tiff = F.when(k.isin(0, 1), "2024:01:02 03:04:05").when(k == 3, "2024:01:02 03:04:05")
    xmp = F.when(k == 0, "2024-01-02 03:04:05").when(k == 2, "2023:05:06 07:08:09").when(k == 3, "2022-01-02T03:04:05Z")
    dates = r.header_dates(tiff, xmp, k != 4, F.lit("2020-01-01T00:00:00Z"))
    return t.events.select("event_id", dates.alias("d")).select("event_id", "d.tiff", "d.xmp")


@query("image_resolution", "select p_partkey, case when p_partkey % 3 = 0 then 300 when p_partkey % 3 = 1 then 600 when p_size * 10 < 100 then 600 else p_size * 10 end as resolution from part")
def image_resolution(t: Tables) -> DataFrame:
    old = F.when(F.col("p_partkey") % 3 != 1, F.col("p_size") * 10)
    forced = F.when(F.col("p_partkey") % 3 == 0, 300)
    return t.part.select("p_partkey", r.header_resolution(old, F.lit("in"), forced, F.lit(600)).alias("resolution"))


@query("png_resolution", "select p_partkey, cast(round(case when p_partkey % 2 = 0 then p_size * 1000 * 0.0254::double else p_size * 1000 end) as bigint) as dpi from part")
def png_resolution(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", r.png_resolution((F.col("p_size") * 1000).cast("double"), F.when(F.col("p_partkey") % 2 == 0, "meters").otherwise("inches")).alias("dpi"))


@query("scan_times", """
  select o_orderkey, case o_orderkey % 4 when 0 then '2011-02-03T00:05:06Z' when 1 then '2012-03-04T05:06:07Z' when 2 then '2013-04-05T06:07:08Z' else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') end as scanned from orders""")  # fmt: skip
def scan_times(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 4
    at = r.scan_time(F.when(k == 0, "20110203240506").otherwise("soon"), F.when(k == 1, "20120304050607"), F.when(k < 3, "20130405060708"), F.col("o_orderdate"))
    return t.orders.select("o_orderkey", at.alias("scanned"))


@query("page_file_names", "select conv_id, turn, concat(lpad(cast(turn as string), 8, '0'), '.jp2') as file from conversations")
def page_file_names(t: Tables) -> DataFrame:
    name = F.concat(F.lit("item_"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(".jp2"))
    return t.conversations.select("conv_id", "turn", r.page_file(name, "jp2").alias("file"))


@query("error_triage", "select event_id, case event_id % 3 when 0 then 'first' when 1 then 'second' else 'fatal' end as tool from events")
def error_triage(t: Tables) -> DataFrame:
    message = F.element_at(F.array(*map(F.lit, ("Tag 1 out of sequence", "Invalid DateTime length", "IFD offset"))), (F.col("event_id") % 3 + 1).cast("int"))
    return t.events.select("event_id", r.triage(message, ["Tag"], ["Invalid DateTime"]).alias("tool"))
