"""The tables of the ingest domain, derived from the star-schema test tables.

Every table is one SELECT that Spark and DuckDB read alike, so that a query and
its oracle start from the same rows. {version} stands for the one expression that
the dialects spell differently, a timestamp as yyyyMMddHHmmss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = tuple("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())

#: name: (tables it reads, SELECT)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "feed_queue": (("orders", "lineitem"), """
        select case o_orderkey % 4 when 0 then 'ia' when 1 then 'simple' when 2 then 'epub' else 'emma' end as pkg_type,
          concat('ns', cast(o_custkey % 5 as string)) as namespace, cast(o_orderkey as string) as id,
          case when o_orderstatus = 'P' then 'punted' when o_orderstatus = 'F' then 'collated'
               when o_orderkey % 3 = 0 then 'ready' when o_orderkey % 3 = 1 then 'unpacked' else 'validated' end as status,
          case when o_orderkey % 3 = 1 then 'ready' when o_orderkey % 3 = 2 then 'src_metsed' end as reset_status,
          o_orderdate as date_added, coalesce(l.ship, o_orderdate) as update_stamp,
          case when o_orderstatus = 'O' and o_orderkey % 3 > 0 then concat('node', cast(o_orderkey % 7 as string)) end as node,
          coalesce(l.fails, 0) as failure_count,
          case when o_orderkey % 41 > 0 then cast(substr(o_orderpriority, 1, 1) as int) end as priority
        from {orders} left join (
          select l_orderkey, max(l_shipdate) as ship, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as fails
          from {lineitem} group by l_orderkey) l on l.l_orderkey = o_orderkey"""),
    "feed_log": (("events", "orders"), """
        select event_id, case when event_type = 'error' then 'ERROR' else 'INFO' end as level, ts as logged_at, event_type as operation,
          concat('ns', cast(o_custkey % 5 as string)) as namespace, cast(o_orderkey as string) as id,
          case event_type when 'error' then 'Checksum error' when 'click' then 'Running stage' when 'view' then 'Stage succeeded'
               when 'purchase' then 'Stage failed' else 'Volume punted' end as message,
          case event_id % 3 when 0 then 'checksum' when 1 then 'title' end as field, props as detail
        from {events} join {orders} on o_orderkey = user_id * 3 + event_id % 3"""),
    "feed_backups": (("lineitem",), """
        select concat('ns', cast(l_suppkey % 5 as string)) as namespace, cast(l_partkey as string) as id, {version} as version,
          case l_linenumber % 2 when 0 then 'versioned' else 'objectstore' end as storage_name,
          cast(floor(l_extendedprice) as bigint) as zip_size, cast(floor(l_extendedprice * l_discount) as bigint) as mets_size,
          md5(concat(cast(l_orderkey as string), '/', cast(l_linenumber as string))) as saved_md5sum,
          l_shipdate as lastchecked, l_orderkey as object_no, l_linenumber as object_part,
          case when l_returnflag = 'R' then 1 end as deleted
        from {lineitem}"""),
    "storage_listing": (("lineitem",), """
        select concat('ns', cast(l_suppkey % 5 as string)) as namespace, cast(l_partkey as string) as id, {version} as version,
          case l_linenumber % 2 when 0 then 'versioned' else 'objectstore' end as storage_name,
          l_orderkey as object_no, l_linenumber as object_part, f.ext as ext,
          md5(concat(cast(l_orderkey + case when l_orderkey % 53 = 0 then 1 else 0 end as string), '/', cast(l_linenumber as string))) as real_md5sum
        from {lineitem} cross join (select 'zip' as ext union all select 'mets.xml' as ext) f
        where not (l_orderkey % 31 = 0) and not (f.ext = 'zip' and l_orderkey % 37 = 0) and not (f.ext = 'mets.xml' and l_orderkey % 43 = 0)"""),
    "feed_audit": (("part",), """
        select concat('ns', cast(p_partkey % 5 as string)) as namespace, cast(p_partkey as string) as id, cast(p_partkey % 24 + 1 as int) as sdr_partition,
          cast(floor(p_retailprice * 10) as bigint) as zip_size, cast(p_size * 7 as bigint) as mets_size, p_size as page_count,
          case when p_partkey % 9 > 0 then date '2024-01-01' + cast(p_partkey % 300 as int) end as lastmd5check,
          case p_partkey % 7 when 0 then 0 when 1 then null else 1 end as md5check_ok
        from {part}"""),
    "zephir_items": (("customer", "orders"), """
        select concat('ns', cast(o_custkey % 5 as string)) as namespace, cast(o_orderkey as string) as id,
          concat('COLL', cast(c_nationkey as string)) as collection, case o_orderkey % 3 when 0 then 'google' when 1 then 'archive' else 'umich' end as digitization_source,
          0 as returned
        from {orders} join {customer} on c_custkey = o_custkey where o_orderkey % 11 > 0"""),
    "queue_disallow": (("orders",), """
        select concat('ns', cast(o_custkey % 5 as string)) as namespace, cast(o_orderkey as string) as id from {orders} where o_orderkey % 13 = 0"""),
    "candidates": (("orders",), """
        select concat('ns', cast(o_custkey % 5 as string)) as namespace, cast(case when o_orderkey % 2 = 0 then o_orderkey else o_orderkey + 10000000 end as string) as id,
          'simple' as pkg_type, concat('ns', cast(o_custkey % 5 as string)) as item_namespace, cast(o_orderkey as string) as item_id
        from {orders} where o_orderkey % 3 = 1"""),
    "collections": (("nation", "region"), """
        select concat('COLL', cast(n_nationkey as string)) as collection, lower(n_name) as content_provider_cluster, lower(r_name) as responsible_entity
        from {nation} join {region} on r_regionkey = n_regionkey where n_nationkey % 12 > 0"""),
    "digitizers": (("nation",), """
        select concat('COLL', cast(n_nationkey as string)) as collection, s.source as digitization_source, case when (n_nationkey + s.n) % 3 > 0 then s.profile end as access_profile
        from {nation} cross join (select 'google' as source, 'google' as profile, 0 as n union all select 'archive' as source, 'open' as profile, 1 as n) s
        where (n_nationkey + s.n) % 5 > 0"""),
    "source_names": (("region",), """
        select * from (select 'google' as name, 'Google' as display_name union all select 'archive' as name, 'Internet Archive' as display_name union all select 'umich' as name, 'University of Michigan' as display_name) s"""),
    "volume_files": (("conversations",), """
        select conv_id as volume, concat(case when f.ext = 'jp2' and conv_id % 17 = 0 and turn = 0 then 'bad ' else '' end, lpad(cast(turn + 1 + case when conv_id % 6 = 0 and turn > 1 then 1 else 0 end as string), 8, '0'), '.', f.ext) as file,
          turn + 1 + case when conv_id % 6 = 0 and turn > 1 then 1 else 0 end as page, f.ext as ext,
          md5(concat(cast(conv_id as string), ':', cast(turn as string), ':', f.ext)) as md5sum, length(text) as size
        from {conversations} cross join (select 'jp2' as ext union all select 'tif' as ext union all select 'txt' as ext union all select 'xml' as ext) f
        where (f.ext = 'jp2' and (conv_id + turn) % 11 > 0) or (f.ext = 'txt' and (conv_id * 3 + turn) % 13 > 0 and conv_id % 19 > 0)
          or (f.ext = 'xml' and role = 'assistant' and conv_id % 5 > 0) or (f.ext = 'tif' and (conv_id + 2 * turn) % 23 = 0)"""),
    "manifest": (("conversations",), """
        select conv_id as volume, concat(lpad(cast(turn + 1 + case when conv_id % 6 = 0 and turn > 1 then 1 else 0 end as string), 8, '0'), '.', f.ext) as file,
          case when (conv_id + turn) % 19 = 0 then md5('changed') else md5(concat(cast(conv_id as string), ':', cast(turn as string), ':', f.ext)) end as md5sum
        from {conversations} cross join (select 'jp2' as ext union all select 'txt' as ext) f where (conv_id + 5 * turn) % 29 > 0"""),
    "filegroups": (("region",), """
        select * from (
          select 'image' as name, '^[0-9]{{8}}\\.(jp2|tif)$' as pattern, 1 as required, 1 as sequence, 1 as content, 0 as utf8 union all
          select 'ocr' as name, '^[0-9]{{8}}\\.txt$' as pattern, 1 as required, 1 as sequence, 1 as content, 1 as utf8 union all
          select 'coordOCR' as name, '^[0-9]{{8}}\\.xml$' as pattern, 0 as required, 1 as sequence, 1 as content, 1 as utf8) g"""),
    "tech_metadata": (("lineitem",), """
        select l_orderkey as volume, concat(lpad(cast(l_linenumber as string), 8, '0'), '.tif') as file,
          case when l_orderkey % 29 = 0 then 'JPEG' else 'TIFF' end as format,
          case when l_quantity > 45 then 'Not well-formed' else 'Well-Formed and valid' end as status,
          case when l_tax > 0.07 then null when l_tax > 0.06 then '600/1' when l_tax > 0.05 then '300' else '600' end as resolution,
          cast(cast(l_quantity as int) * 100 - 100 as string) as width, cast(cast(floor(l_discount * 100) as int) * 200 as string) as height,
          case when l_linenumber = 7 then '8' else '1' end as bits, case when l_orderkey % 23 = 0 then 2 else 1 end as n_resolution
        from {lineitem}"""),
    "metric_events": (("events",), """
        select concat('ingest_', event_type, '_seconds_total') as metric, concat('ns', cast(user_id % 4 as string)) as namespace, event_id,
          cast(floor(coalesce(value, 0)) as bigint) as amount
        from {events}"""),
    "premis_events": (("events",), """
        select user_id as volume, case event_type when 'click' then 'capture' when 'view' then 'message digest calculation' when 'purchase' then 'validation' when 'signup' then 'ingestion' else 'fixity check' end as eventtype,
          ts as date, event_id % 3 as origin, md5(concat(cast(user_id as string), event_type, cast(event_id % 2 as string))) as eventid, event_id
        from {events}"""),
}
VERSION = {"spark": "date_format(l_shipdate, 'yyyyMMddHHmmss')", "duckdb": "strftime(l_shipdate, '%Y%m%d%H%M%S')"}
#: A backslash in a Spark SQL literal is doubled.
SLASH = {"spark": "\\\\", "duckdb": "\\"}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of TABLES, or a base table, under sf_dir."""
    if name in BASE:
        return base(spark, sf_dir, name)
    reads, text = TABLES[name]
    text = text.replace("{version}", VERSION["spark"]).replace("\\", SLASH["spark"])
    return spark.sql(text, **{t: base(spark, sf_dir, t) for t in reads})


def oracle(sql: str, *uses: str) -> str:
    """sql with the derived tables that it uses as leading common table expressions, for DuckDB."""
    parts = []
    for name in uses:
        reads, text = TABLES[name]
        parts.append(f"{name} as ({text.replace('{version}', VERSION['duckdb']).format(**{t: t for t in reads})})")
    sql = sql.strip()
    if not parts:
        return sql
    if sql.lower().startswith("with recursive"):
        return f"with recursive {', '.join(parts)}, {sql[len('with recursive'):].strip()}"
    if sql.lower().startswith("with"):
        return f"with {', '.join(parts)}, {sql[len('with'):].strip()}"
    return f"with {', '.join(parts)} {sql}"
