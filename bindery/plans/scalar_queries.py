"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..sources.readers import pairtree_decode, pairtree_encode
from .registry import Tables, query


def cases(table: dict[str, str], key: str) -> str:
    return f"case {key} " + " ".join("when '{}' then '{}'".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in table.items()) + " end"


@query("pairtree_paths", """
  with ids as (select o_orderkey, concat('ark:/1396/', cast(o_orderkey as string), '.x') as objid from orders)
  select o_orderkey, translate(objid, '/:.', '=+,') as encoded, objid as decoded,
    concat('/base/ns/', substr(translate(objid, '/:.', '=+,'), 1, greatest(length(objid) - 4, 3)), '/', translate(objid, '/:.', '=+,'), '.20240101000000.zip') as version_path from ids""")  # fmt: skip
def pairtree_paths(t: Tables) -> DataFrame:
    ids = t.orders.select("o_orderkey", pairtree_encode(F.concat(F.lit("ark:/1396/"), F.col("o_orderkey").cast("string"), F.lit(".x"))).alias("encoded"))
    return ids.select("o_orderkey", "encoded", pairtree_decode(F.col("encoded")).alias("decoded"), s.version_path(F.lit("/base"), F.lit("ns"), F.col("encoded"), F.lit("20240101000000")).alias("version_path"))


@query("md5_forms", "select doc_id, md5(text) as md5_hex, base64(unhex(md5(text))) as md5_base64, md5(text) as back from documents")
def md5_forms(t: Tables) -> DataFrame:
    done = t.documents.select("doc_id", F.md5("text").alias("md5_hex")).withColumn("md5_base64", s.md5_base64(F.col("md5_hex")))
    return done.withColumn("back", s.md5_from_base64(F.col("md5_base64")))


@query("luhn_ids", """
  with codes as (select o_orderkey, concat('39015', lpad(cast(o_orderkey as string), 9, '0')) as barcode from orders)
  select o_orderkey, list_sum(list_transform(range(1, 15), lambda i: case when i % 2 = 0 then cast(substr(barcode, i, 1) as int)
    else case when cast(substr(barcode, i, 1) as int) > 4 then 2 * cast(substr(barcode, i, 1) as int) - 9 else 2 * cast(substr(barcode, i, 1) as int) end end)) % 10 = 0 as valid from codes""")  # fmt: skip
def luhn_ids(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", s.luhn_valid("39015", F.concat(F.lit("39015"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))).alias("valid"))


@query("noid_check", f"""
  with names as (select o_orderkey, concat('13960/t', cast(o_orderkey as string)) as name from orders),
  sums as (select o_orderkey, name, list_sum(list_transform(range(1, length(name) + 1), lambda i: greatest(instr('{s.NOID_ALPHABET}', substr(name, i, 1)) - 1, 0) * i)) as total from names)
  select o_orderkey, substr('{s.NOID_ALPHABET}', cast(total % 29 as int) + 1, 1) as check_char, true as valid from sums""")  # fmt: skip
def noid_check(t: Tables) -> DataFrame:
    name = F.concat(F.lit("13960/t"), F.col("o_orderkey").cast("string"))
    done = t.orders.select("o_orderkey", name.alias("name"), s.noid_check_char(name).alias("check_char"))
    return done.select("o_orderkey", "check_char", s.ark_valid(F.concat(F.lit("ark:/"), "name", "check_char")).alias("valid"))


@query("event_uuids", """
  with h as (select event_id, md5(unhex('09A5DAD6348411E09D45077BD5215A96') || encode(concat('ns-', cast(user_id as string), '-', event_type, '-2024'))) as h from events)
  select event_id, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-3', substr(h, 14, 3), '-', substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1), substr(h, 18, 3), '-', substr(h, 21, 12)) as uuid from h""")  # fmt: skip
def event_uuids(t: Tables) -> DataFrame:
    return t.events.select("event_id", s.event_uuid(F.lit("ns"), F.col("user_id").cast("string"), F.col("event_type"), F.lit("2024")).alias("uuid"))


DATE_FORMS = """case event_id % 5 when 0 then concat('2024:01:', lpad(cast(user_id % 28 + 1 as string), 2, '0'), ' 10:20:30') when 1 then concat('2024-01-', lpad(cast(user_id % 28 + 1 as string), 2, '0'), 'T10:20')
  when 2 then concat('2024/01/', lpad(cast(user_id % 28 + 1 as string), 2, '0'), ' 10:20:30+05:00') when 3 then concat('01/', lpad(cast(user_id % 28 + 1 as string), 2, '0'), '/97') else 'not a date' end"""


@query("iso_dates", f"""
  with d as (select event_id, lpad(cast(user_id % 28 + 1 as string), 2, '0') as dd, {DATE_FORMS} as given from events)
  select event_id, given, case event_id % 5 when 0 then concat('2024-01-', dd, 'T10:20:30Z') when 1 then concat('2024-01-', dd, 'T10:20:00Z') when 2 then concat('2024-01-', dd, 'T10:20:30+05:00') end as iso from d""")  # fmt: skip
def iso_dates(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.expr(DATE_FORMS).alias("given")).withColumn("iso", s.iso_date(F.col("given")))


@query("tiff_dates", f"""
  with d as (select event_id, lpad(cast(user_id % 28 + 1 as string), 2, '0') as dd, {DATE_FORMS} as given from events)
  select event_id, given, case event_id % 5 when 0 then concat('2024:01:', dd, ' 10:20:30') when 1 then concat('2024:01:', dd, ' 00:00:00') when 2 then concat('2024:01:', dd, ' 10:20:30') when 3 then concat('1997:01:', dd, ' 00:00:00') end as tiff from d""")  # fmt: skip
def tiff_dates(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.expr(DATE_FORMS).alias("given")).withColumn("tiff", s.tiff_date(F.col("given")))


@query("tz_convert", "select o_orderkey, strftime((o_orderdate at time zone 'America/Detroit') at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as utc from orders")
def tz_convert(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", s.utc_text(F.col("o_orderdate"), "America/Detroit").alias("utc"))


@query("dpi", """
  with u as (select p_partkey, p_size, case p_partkey % 4 when 0 then 'cm' when 1 then 'in' when 2 then 'mm' else 'furlong' end as unit from part)
  select p_partkey, unit, cast(case unit when 'cm' then round_even(p_size * 2.54::double, 0) when 'in' then p_size when 'mm' then round_even(p_size * 25.4::double, 0) end as bigint) as dpi from u""")  # fmt: skip
def dpi(t: Tables) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("cm", "in", "mm", "furlong"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t.part.select("p_partkey", unit.alias("unit"), s.dpi(F.col("p_size").cast("double"), unit).alias("dpi"))


@query("jp2_levels", "select l_orderkey, l_linenumber, cast(greatest(5, ceil(log2(greatest(l_partkey * 7 + 1, l_suppkey * 3 + 1) / 100.0::double)) - 1) as integer) as levels from lineitem where l_linenumber <= 2")
def jp2_levels(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_linenumber <= 2").select("l_orderkey", "l_linenumber", s.decomposition_levels(F.col("l_partkey") * 7 + 1, F.col("l_suppkey") * 3 + 1).alias("levels"))


@query("docname_check", "select volume, file, volume % 3 <> 1 as ok from volume_files", "volume_files")
def docname_check(t: Tables) -> DataFrame:
    name = F.concat(F.lit("X/"), F.when(F.col("volume") % 3 == 1, "other").otherwise(F.col("volume").cast("string")), F.lit("/"), F.upper("file"))
    return t.volume_files.select("volume", "file", s.document_name_ok(name, F.col("volume").cast("string"), F.col("file")).alias("ok"))


PAGE_TYPES = "case turn % 6 when 0 then 'Title Page' when 1 then 'Blank Tissue' when 2 then 'Normal' when 3 then 'Contents' when 4 then 'Cover' else 'Index' end"


@query("page_tags", f"""
  with p as (select conv_id, turn, case when turn % 3 = 0 then 'LEFT' when turn % 3 = 1 then 'RIGHT' else '' end as side, {PAGE_TYPES} as page_type from conversations)
  select conv_id, turn, nullif(concat_ws(', ', nullif(side, ''), {cases(s.PAGE_TAGS, "page_type")}), '') as label from p""")  # fmt: skip
def page_tags(t: Tables) -> DataFrame:
    side = F.when(F.col("turn") % 3 == 0, "LEFT").when(F.col("turn") % 3 == 1, "RIGHT").otherwise("")
    return t.conversations.select("conv_id", "turn", s.page_label(side, F.expr(PAGE_TYPES)).alias("label"))


@query("tag_whitelist", """
  select conv_id, turn, case turn % 4 when 0 then 'TITLE' when 1 then 'TITLE, INDEX' when 2 then 'INDEX' end as kept from conversations""")  # fmt: skip
def tag_whitelist(t: Tables) -> DataFrame:
    given = F.element_at(F.array(*map(F.lit, ("TITLE", "TITLE,  INDEX", "UNKNOWN, INDEX", "NONE"))), (F.col("turn") % 4 + 1).cast("int"))
    return t.conversations.select("conv_id", "turn", s.allowed_tags(given, ["TITLE", "INDEX"]).alias("kept"))


AGENT_VALUES = "case c_custkey % 5 when 0 then 'MiU' when 1 then 'GEU-S' when 2 then 'Internet Archive' when 3 then 'UNKNOWN' else 'nobody' end"
AGENT_KINDS = "case c_custkey % 4 when 0 then 'MARC21 Code' when 1 then 'AgentID' when 2 then 'Repository AgentID' else 'tool' end"


@query("agent_migration", f"""
  with g as (select c_custkey, {AGENT_KINDS} as kind, {AGENT_VALUES} as value, case when c_custkey % 3 = 0 then 'mdp' else 'ns' end as namespace from customer)
  select c_custkey, case when kind in ('MARC21 Code', 'AgentID') then coalesce({cases(s.AGENTS, "value")}, 'BadValue') when kind = 'Repository AgentID' then case when value = 'UNKNOWN' and namespace = 'mdp' then 'umich' else 'BadValue' end else value end as agent from g""")  # fmt: skip
def agent_migration(t: Tables) -> DataFrame:
    namespace = F.when(F.col("c_custkey") % 3 == 0, "mdp").otherwise("ns")
    return t.customer.select("c_custkey", s.migrate_agent(F.expr(AGENT_KINDS), F.expr(AGENT_VALUES), namespace).alias("agent"))


ERROR_CODES = "case event_id % 4 when 0 then 'BadUTF' when 1 then 'ToolVersionError' when 2 then 'NoBibData' else 'SomethingElse' end"


@query("error_messages", f"with e as (select event_id, {ERROR_CODES} as code from events) select event_id, coalesce({cases(s.ERRORS, 'code')}, code) as message from e")
def error_messages(t: Tables) -> DataFrame:
    return t.events.select("event_id", s.error_text(F.expr(ERROR_CODES)).alias("message"))


@query("label_parse", "select event_id, event_type as kind, cast(user_id as string) as owner from events")
def label_parse(t: Tables) -> DataFrame:
    parsed = s.labels(F.concat(F.lit("kind:"), "event_type", F.lit(";owner:"), F.col("user_id").cast("string")))
    return t.events.select("event_id", parsed["kind"].alias("kind"), parsed["owner"].alias("owner"))


AGENT_LISTS = "case c_custkey % 3 when 0 then 'google;archive*' when 1 then 'umich;google' else 'archive*;umich' end"


@query("agent_split", """
  with a as (select c_custkey, unnest(case c_custkey % 3 when 0 then [{'agent': 'google', 'display': 'no'}, {'agent': 'archive', 'display': 'yes'}] when 1 then [{'agent': 'umich', 'display': 'no'}, {'agent': 'google', 'display': 'yes'}]
    else [{'agent': 'archive', 'display': 'yes'}, {'agent': 'umich', 'display': 'no'}] end) as x from customer)
  select c_custkey, x.agent as agent, x.display as display from a""")  # fmt: skip
def agent_split(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.inline(s.source_agents(F.expr(AGENT_LISTS))))


@query("capture_agent", "select c_custkey, case c_custkey % 3 when 0 then 'archive' when 1 then 'umich' else 'archive' end as agent from customer")
def capture_agent(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", s.capture_agent(F.expr(AGENT_LISTS)).alias("agent"))


@query("checksum_lookup", "select c_custkey, case when c_custkey % 3 < 2 then md5(c_name) end as md5sum from customer")
def checksum_lookup(t: Tables) -> DataFrame:
    name = F.concat(F.lit("a "), F.col("c_custkey").cast("string"), F.lit(".zip"))
    key = F.when(F.col("c_custkey") % 3 == 0, name).otherwise(F.replace(name, F.lit(" "), F.lit("%20")))
    held = F.create_map(key, F.when(F.col("c_custkey") % 3 < 2, F.md5("c_name")).otherwise("short"))
    return t.customer.select("c_custkey", s.md5_lookup(held, name).alias("md5sum"))
