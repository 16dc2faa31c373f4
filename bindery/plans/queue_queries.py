"""Queries over the work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import queueing as q
from ..sources import sinks
from .registry import Tables, query

RELEASED = ", ".join(f"'{s}'" for s in q.RELEASE_STATES)


@query("status_summary", "select pkg_type, status, count(*) as n from feed_queue where update_stamp >= timestamp '1996-01-01' and update_stamp < timestamp '1999-01-01' group by pkg_type, status", "feed_queue")
def status_summary(t: Tables) -> DataFrame:
    window = (F.col("update_stamp") >= F.lit("1996-01-01").cast("timestamp")) & (F.col("update_stamp") < F.lit("1999-01-01").cast("timestamp"))
    return t.feed_queue.filter(window).groupBy("pkg_type", "status").agg(F.count("*").alias("n"))


@query("punted_error_summary", """
  with last_error as (select * from (select *, row_number() over (partition by namespace, id order by logged_at desc, event_id desc) as r from feed_log where level = 'ERROR') where r = 1)
  select q.pkg_type, e.message, e.operation, e.field, count(*) as n from feed_queue q join last_error e using (namespace, id) where q.status = 'punted' or q.failure_count > 1 group by all""", "feed_queue", "feed_log")  # fmt: skip
def punted_error_summary(t: Tables) -> DataFrame:
    punted = t.feed_queue.filter("status = 'punted' or failure_count > 1").select(*q.KEY, "pkg_type")
    return punted.join(q.last_errors(t.feed_log), q.KEY).groupBy("pkg_type", "message", "operation", "field").agg(F.count("*").alias("n"))


@query("claim_top_n", f"""
  select namespace, id, pkg_type, status, status as reset_status, 'node1' as node from feed_queue
  where node is null and status not in ({RELEASED}) order by priority asc nulls first, date_added, namespace, id limit 32""", "feed_queue")  # fmt: skip
def claim_top_n(t: Tables) -> DataFrame:
    return q.claim(t.feed_queue, "node1", 32).select(*q.KEY, "pkg_type", "status", "reset_status", "node")


def _reset(level: int) -> None:
    where = {1: "node is null and status in ('punted')", 2: "node is null and status in ('punted', 'collated', 'rights', 'done')", 3: "true"}[level]

    @query(f"reset_level_{level}", f"select namespace, id, 'ready' as status, cast(0 as bigint) as failure_count from feed_queue where {where}", "feed_queue")
    def reset(t: Tables) -> DataFrame:
        return q.reset(t.feed_queue, level).select(*q.KEY, "status", "failure_count")


for _level in (1, 2, 3):
    _reset(_level)


@query("enqueue_gate", """
  select c.namespace, c.id, case when z.id is null then 'NoBibData' when d.id is not null then 'Disallowed' when f.id is not null then 'ignored' else 'added' end as outcome
  from candidates c left join zephir_items z on z.namespace = c.item_namespace and z.id = c.item_id
  left join queue_disallow d on d.namespace = c.item_namespace and d.id = c.item_id left join feed_queue f on f.namespace = c.namespace and f.id = c.id""",
  "candidates", "zephir_items", "queue_disallow", "feed_queue")
def enqueue_gate(t: Tables) -> DataFrame:
    known = t.zephir_items.select(*q.KEY)
    double = lambda df: df.union(df.withColumn("id", (F.col("id").cast("long") + 10000000).cast("string")))  # noqa: E731  both id forms of an item
    return q.enqueue_gate(t.candidates, double(known), double(t.queue_disallow), t.feed_queue).select(*q.KEY, "outcome")


@query("mark_returned", """
  select z.namespace, z.id, cast(case when d.id is null then 1 else z.returned end as integer) as returned from zephir_items z left join queue_disallow d using (namespace, id)""", "zephir_items", "queue_disallow")  # fmt: skip
def mark_returned(t: Tables) -> DataFrame:
    outcomes = q.enqueue_gate(t.feed_queue, t.zephir_items, t.queue_disallow, t.feed_queue)
    return q.mark_returned(t.zephir_items, outcomes).select(*q.KEY, "returned")


@query("locks_per_node", "select node, count(*) as locks from feed_queue where node is not null group by node", "feed_queue")
def locks_per_node(t: Tables) -> DataFrame:
    return q.locks(t.feed_queue)


@query("capacity_top_up", f"""
  with ranked as (select namespace, id, row_number() over (order by priority asc nulls first, date_added, namespace, id) as r from feed_queue where node is null and status not in ({RELEASED}))
  select namespace, id from ranked where r <= greatest(0, 1000 - (select count(*) from feed_queue where node = 'node3'))""", "feed_queue")  # fmt: skip
def capacity_top_up(t: Tables) -> DataFrame:
    return q.top_up(t.feed_queue, "node3", 1000).select(*q.KEY)


@query("volumes_with_status", "select namespace, id from feed_queue where pkg_type = 'ia' and status = 'ready' order by namespace, id limit 50", "feed_queue")
def volumes_with_status(t: Tables) -> DataFrame:
    found = t.feed_queue.filter("pkg_type = 'ia' and status = 'ready'").select(*q.KEY)
    return q.top(found, 50, F.col("namespace"), F.col("id"))


@query("status_lookup", """
  with last_error as (select * from (select *, row_number() over (partition by namespace, id order by logged_at desc, event_id desc) as r from feed_log where level = 'ERROR') where r = 1)
  select concat(q.namespace, '.', q.id) as htid, q.status, e.message as last_message from feed_queue q left join last_error e using (namespace, id) where q.status <> 'collated'""", "feed_queue", "feed_log")  # fmt: skip
def status_lookup(t: Tables) -> DataFrame:
    joined = t.feed_queue.filter("status <> 'collated'").join(q.last_errors(t.feed_log).select(*q.KEY, "message"), q.KEY, "left")
    return joined.select(F.concat_ws(".", *q.KEY).alias("htid"), "status", F.col("message").alias("last_message"))


@query("insert_ignore", """
  select c.namespace, c.id, c.pkg_type from candidates c where not exists (select 1 from feed_queue f where f.namespace = c.namespace and f.id = c.id)""", "candidates", "feed_queue")  # fmt: skip
def insert_ignore(t: Tables) -> DataFrame:
    return sinks.insert_ignore(t.feed_queue, t.candidates.select(*q.KEY, "pkg_type"), q.KEY)


@query("insert_duplicates", "select namespace, id from candidates where (namespace, id) in (select (namespace, id) from feed_queue)", "candidates", "feed_queue")
def insert_duplicates(t: Tables) -> DataFrame:
    return sinks.duplicates(t.feed_queue, t.candidates.select(*q.KEY), q.KEY)


@query("queue_update", f"""
  with results as (select namespace, id, case when cast(id as bigint) % 2 = 0 then 'collated' else 'unpacked' end as new_status, cast(id as bigint) % 5 = 0 as fail from feed_queue where status <> 'punted' and cast(id as bigint) % 4 < 3)
  select f.namespace, f.id, coalesce(r.new_status, f.status) as status, f.failure_count + case when r.fail then 1 else 0 end as failure_count,
    case when r.new_status in ({RELEASED}) then null else f.node end as node from feed_queue f left join results r using (namespace, id)""", "feed_queue")  # fmt: skip
def queue_update(t: Tables) -> DataFrame:
    number = F.col("id").cast("long")
    results = t.feed_queue.filter((F.col("status") != "punted") & (number % 4 < 3)).select(*q.KEY, F.when(number % 2 == 0, "collated").otherwise("unpacked").alias("new_status"), (number % 5 == 0).alias("fail"))
    return q.update_queue(t.feed_queue, results).select(*q.KEY, "status", "failure_count", "node")


@query("reset_in_flight", f"select namespace, id, coalesce(reset_status, status) as status from feed_queue where node = 'node2' and status not in ({RELEASED})", "feed_queue")
def reset_in_flight(t: Tables) -> DataFrame:
    return q.release_in_flight(t.feed_queue, "node2").select(*q.KEY, "status")


@query("release_filter", f"""
  select concat('{{"namespace":"', namespace, '","id":"', id, '","pkg_type":"', pkg_type, '","status":"', status, '"}}') as body, coalesce(priority, 2) as priority
  from feed_queue where status not in ({RELEASED})""", "feed_queue")  # fmt: skip
def release_filter(t: Tables) -> DataFrame:
    return q.messages(t.feed_queue)


@query("message_validity", """
  select event_id, case when event_id % 7 = 0 or event_id % 5 = 0 or user_id = 0 then 'rejected' else 'accepted' end as verdict from events""")  # fmt: skip
def message_validity(t: Tables) -> DataFrame:
    from ..sources.readers import valid_message

    body = F.when(F.col("event_id") % 7 == 0, "not json").otherwise(F.to_json(F.struct(F.concat(F.lit("ns"), (F.col("user_id") % 5).cast("string")).alias("namespace"), F.col("user_id").cast("string").alias("id"), F.when(F.col("event_id") % 5 > 0, "ia").otherwise("").alias("pkg_type"), F.lit("ready").alias("status"))))
    return t.events.select("event_id", F.when(valid_message(body), "accepted").otherwise("rejected").alias("verdict"))


@query("premis_replace", """
  with ranked as (select volume, eventtype, eventid, origin, row_number() over (partition by volume, eventtype order by case when event_id % 2 = 1 then 1 else 0 end desc, event_id desc) as r from premis_events)
  select volume, eventtype, eventid, origin from ranked where r = 1""", "premis_events")  # fmt: skip
def premis_replace(t: Tables) -> DataFrame:
    rows = t.premis_events
    return sinks.replace_into(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), ["volume", "eventtype"], "event_id").select("volume", "eventtype", "eventid", "origin")


@query("premis_delete", "select volume, eventtype, event_id from premis_events where volume not in (select volume from premis_events where eventtype = 'fixity check' and event_id % 9 = 0)", "premis_events")
def premis_delete(t: Tables) -> DataFrame:
    return sinks.delete(t.premis_events, t.premis_events.filter("eventtype = 'fixity check' and event_id % 9 = 0"), ["volume"]).select("volume", "eventtype", "event_id")
