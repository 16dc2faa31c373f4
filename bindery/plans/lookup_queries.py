"""Queries of look-ups, the state machine, telemetry and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import lookups as lk
from ..operators import machine, queueing, telemetry
from ..sources.sinks import detail_text, log_rows
from ..streaming import delivery, jobs, ledger
from .registry import Tables, query


@query("source_lookup", """
  select z.namespace, z.id, c.responsible_entity, d.access_profile, s.display_name, case when d.access_profile is null then 'MissingField' else 'ok' end as status
  from zephir_items z join collections c using (collection) left join digitizers d using (collection, digitization_source) join source_names s on z.digitization_source = s.name""",
  "zephir_items", "collections", "digitizers", "source_names")
def source_lookup(t: Tables) -> DataFrame:
    return lk.sources(t.zephir_items, t.collections, t.digitizers, t.source_names).select("namespace", "id", "responsible_entity", "access_profile", "display_name", "status")


@query("access_profile", """
  select z.namespace, z.id, case when d.collection is null then 'BadValue' when d.access_profile is null then 'MissingField' else 'ok' end as status
  from zephir_items z left join digitizers d using (collection, digitization_source)""", "zephir_items", "digitizers")  # fmt: skip
def access_profile(t: Tables) -> DataFrame:
    return lk.access_profile(t.zephir_items, t.digitizers).select("namespace", "id", "status")


@query("page_data", """
  with features as (select conv_id as volume, turn + 1 as page, case when turn % 3 = 0 then 'TITLE' when turn % 3 = 1 then 'INDEX' end as label from conversations
    union all select conv_id, turn + 1, case when turn % 9 = 0 then 'COVER' else 'TITLE' end from conversations where turn % 3 = 0),
  agreed as (select volume, page, min(label) as label, count(distinct label) as n from features group by volume, page), pages as (select distinct volume, page from volume_files)
  select volume, page, label, case when n > 1 then 'NotEqualValues' else 'ok' end as status from pages left join agreed using (volume, page)""", "volume_files")  # fmt: skip
def page_data(t: Tables) -> DataFrame:
    c = t.conversations.select(F.col("conv_id").alias("volume"), (F.col("turn") + 1).alias("page"), "turn")
    one = c.select("volume", "page", F.when(F.col("turn") % 3 == 0, "TITLE").when(F.col("turn") % 3 == 1, "INDEX").alias("label"))
    two = c.filter("turn % 3 = 0").select("volume", "page", F.when(F.col("turn") % 9 == 0, "COVER").otherwise("TITLE").alias("label"))
    return lk.page_features(t.volume_files.select("volume", "page").distinct(), one.union(two), ["volume", "page"])


@query("config_overlay", """
  with layers as (select p_brand as setting, 0 as layer, max(p_size) as value from part group by p_brand
    union all select p_brand, 1, max(p_size) + 100 from part where p_size > 45 group by p_brand union all select p_brand, 2, min(p_size) + 200 from part where p_size < 2 group by p_brand),
  ranked as (select *, row_number() over (partition by setting order by layer desc) as r from layers)
  select setting, layer, value from ranked where r = 1""")  # fmt: skip
def config_overlay(t: Tables) -> DataFrame:
    def layer(n: int, where: str, value) -> DataFrame:
        return t.part.filter(where).groupBy(F.col("p_brand").alias("setting")).agg(value.alias("value")).select("setting", F.lit(n).alias("layer"), "value")

    layers = layer(0, "true", F.max("p_size")).union(layer(1, "p_size > 45", F.max("p_size") + 100)).union(layer(2, "p_size < 2", F.min("p_size") + 200))
    return lk.overlay(layers, ["setting"])


@query("tag_match", "select concat('ns', cast(c_nationkey as string)) as namespace, count(distinct c_mktsegment) as n_tags, bool_or(c_mktsegment = 'BUILDING') and bool_or(c_mktsegment = 'MACHINERY') as matches from customer group by c_nationkey")
def tag_match(t: Tables) -> DataFrame:
    tags = t.customer.groupBy(F.concat(F.lit("ns"), F.col("c_nationkey").cast("string")).alias("namespace")).agg(F.collect_set("c_mktsegment").alias("tags"))
    return tags.select("namespace", F.size("tags").cast("long").alias("n_tags"), lk.has_tags(F.col("tags"), ["BUILDING", "MACHINERY"]).alias("matches"))


@query("ns_by_pkg", "select pkg_type as value, string_agg(distinct namespace, ',' order by namespace) as namespaces from feed_queue group by pkg_type", "feed_queue")
def ns_by_pkg(t: Tables) -> DataFrame:
    by_namespace = t.feed_queue.groupBy("namespace").agg(F.collect_set("pkg_type").alias("pkg_types"))
    return lk.inverted(by_namespace, "namespace", "pkg_types", "namespaces").withColumn("namespaces", F.array_join("namespaces", ","))


@query("validation_exceptions", "select p_partkey, p_partkey % 6 in (0, 3) or p_partkey % 5 = 1 as skipped from part")
def validation_exceptions(t: Tables) -> DataFrame:
    own = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("resolution"), F.lit("camera"))).otherwise(F.array().cast("array<string>"))
    noted = F.when(F.col("p_partkey") % 5 == 1, F.array(F.lit("resolution"))).otherwise(F.array(F.lit("orientation")))
    return t.part.select("p_partkey", lk.skipped(F.lit("resolution"), own, noted).alias("skipped"))


VALUES = ", ".join(f"('{pkg}', '{a}', '{b}', '{c}', '{d}')" for pkg, stages in machine.STAGES.items() for a, b, c, d in stages)
STAGE_TABLE = f"stages(pkg_type, status, stage, success_state, failure_state) as (select * from (values {VALUES}) v(pkg_type, status, stage, success_state, failure_state))"
RELEASED = ", ".join(f"'{s}'" for s in machine.RELEASE_STATES)
AFTER = "case when s.stage is null then 'punted' when {ok} then s.success_state when {failures} >= 5 then 'punted' else coalesce(nullif(s.failure_state, ''), 'punted') end"


@query("next_status", f"""
  with {STAGE_TABLE}, j as (select *, cast(id as bigint) % 3 > 0 as ok from feed_queue)
  select j.namespace, j.id, s.stage, {AFTER.format(ok='j.ok', failures='j.failure_count')} as new_status, {AFTER.format(ok='j.ok', failures='j.failure_count')} in ({RELEASED}) as release,
    j.failure_count + case when s.stage is null or not j.ok then 1 else 0 end as new_failure_count
  from j left join stages s on s.pkg_type = j.pkg_type and s.status = j.status""", "feed_queue")  # fmt: skip
def next_status(t: Tables) -> DataFrame:
    jobs_ = t.feed_queue.withColumn("success", F.col("id").cast("long") % 3 > 0)
    return machine.step(jobs_, machine.transitions(t.spark)).select("namespace", "id", "stage", "new_status", "release", "new_failure_count")


TRACE_OK = "(length({stage}) + {failures} + cast({id} as bigint)) % 9 > 0"


@query("job_trace", f"""
  with recursive {STAGE_TABLE},
  trace(pkg_type, namespace, id, turn, status, stage, new_status, failures) as (
    select q.pkg_type, q.namespace, q.id, 1, q.status, s.stage, {AFTER.format(ok=TRACE_OK.format(stage='s.stage', failures='q.failure_count', id='q.id'), failures='q.failure_count')},
      q.failure_count + case when s.stage is null or not {TRACE_OK.format(stage='s.stage', failures='q.failure_count', id='q.id')} then 1 else 0 end
    from feed_queue q left join stages s on s.pkg_type = q.pkg_type and s.status = q.status where q.status not in ({RELEASED})
    union all
    select t.pkg_type, t.namespace, t.id, t.turn + 1, t.new_status, s.stage, {AFTER.format(ok=TRACE_OK.format(stage='s.stage', failures='t.failures', id='t.id'), failures='t.failures')},
      t.failures + case when s.stage is null or not {TRACE_OK.format(stage='s.stage', failures='t.failures', id='t.id')} then 1 else 0 end
    from trace t left join stages s on s.pkg_type = t.pkg_type and s.status = t.new_status where t.new_status not in ({RELEASED}))
  select namespace, id, cast(turn as bigint) as turn, status, stage, new_status, failures from trace""", "feed_queue")  # fmt: skip
def job_trace(t: Tables) -> DataFrame:
    live = t.feed_queue.filter(~F.col("status").isin(*machine.RELEASE_STATES)).select("pkg_type", "namespace", "id", "status", "failure_count")
    done = machine.trace(live, lambda stage, failures: (F.length(stage) + failures + F.col("id").cast("long")) % 9 > 0)
    return done.select("namespace", "id", F.col("turn").cast("long").alias("turn"), "status", "stage", "new_status", "failures")


@query("stage_chain", f"""
  with recursive {STAGE_TABLE}, c(pkg_type, first, n, stage, nxt) as (select pkg_type, status, 1, stage, success_state from stages
    union all select c.pkg_type, c.first, c.n + 1, s.stage, s.success_state from c join stages s on s.pkg_type = c.pkg_type and s.status = c.nxt)
  select namespace, id, cast(n as bigint) as n, stage from feed_queue q join c on c.pkg_type = q.pkg_type and c.first = q.status""", "feed_queue")  # fmt: skip
def stage_chain(t: Tables) -> DataFrame:
    """The stages that lie before each job of the queue."""
    return machine.ahead(t.feed_queue).select("namespace", "id", F.col("at").cast("long").alias("n"), "stage")


OWN = (("simple", "ready", "Inspect", "inspected", "held"), ("simple", "inspected", "Download", "downloaded", "ready"))


@query("custom_stages", f"""
  with {STAGE_TABLE}, own(pkg_type, status, stage, success_state, failure_state) as (select * from (values {', '.join(map(str, OWN))}) v(pkg_type, status, stage, success_state, failure_state)),
  s as (select * from own union all select * from stages x where not exists (select 1 from own o where o.pkg_type = x.pkg_type and o.status = x.status)),
  j as (select q.namespace, q.id, q.failure_count, s.stage, s.success_state, s.failure_state, case when q.namespace = 'ns0' then true when q.namespace = 'ns1' then false
      else coalesce(case s.stage when 'Inspect' then coalesce(q.priority, 9) < 4 when 'Unpack' then q.update_stamp >= q.date_added + interval 30 day when 'Pack' then q.failure_count < 2 end, false) end as ok
    from feed_queue q left join s on s.pkg_type = q.pkg_type and s.status = q.status)
  select namespace, id, stage, case when stage is not null then ok end as success, {AFTER.replace('s.', '').format(ok='ok', failures='failure_count')} as new_status, failure_count + case when stage is null or not ok then 1 else 0 end as new_failure_count from j""", "feed_queue")  # fmt: skip
def custom_stages(t: Tables) -> DataFrame:
    """A stage of one's own before the others of its type, outcomes by columns of the job, and two namespaces that are made to pass and to fail."""
    outcomes = {"Inspect": F.coalesce("priority", F.lit(9)) < 4, "Unpack": F.col("update_stamp") >= F.col("date_added") + F.expr("interval 30 days"), "Pack": F.col("failure_count") < 2}
    forced = F.when(F.col("namespace") == "ns0", True).when(F.col("namespace") == "ns1", False)
    done = machine.step(t.feed_queue, machine.transitions(t.spark, OWN), machine.outcome(outcomes, forced))
    return done.select("namespace", "id", "stage", F.when(F.col("stage").isNotNull(), F.col("success")).alias("success"), "new_status", "new_failure_count")


@query("typed_columns", """
  select namespace, id, case pkg_type when 'ia' then concat('IA_', id, '.xml') when 'epub' then concat(namespace, '.', id, '.epub') else concat(id, '.zip') end as package,
    case pkg_type when 'emma' then date_added when 'ia' then coalesce(update_stamp, date_added) else update_stamp end as captured from feed_queue""", "feed_queue")  # fmt: skip
def typed_columns(t: Tables) -> DataFrame:
    """What a package type derives in its own way, beside what all types have in common."""
    common = {"package": F.concat("id", F.lit(".zip")), "captured": F.col("update_stamp")}
    own = {
        "ia": {"package": F.concat(F.lit("IA_"), "id", F.lit(".xml")), "captured": F.coalesce("update_stamp", "date_added")},
        "epub": {"package": F.concat("namespace", F.lit("."), "id", F.lit(".epub"))},
        "emma": {"captured": F.col("date_added")},
    }
    return lk.typed(t.feed_queue, common, own).select("namespace", "id", "package", "captured")


@query("collate_first_failure", """
  select b.namespace, b.id, s.storage, case when cast(b.id as bigint) % 5 = s.n then 'stage' when cast(b.id as bigint) % 7 = 0 then 'validate_zip' when cast(b.id as bigint) % 11 = s.n then 'move' end as failed
  from feed_audit b cross join (select 'pairtree' as storage, 1 as n union all select 'objectstore' as storage, 2 as n) s""", "feed_audit")  # fmt: skip
def collate_first_failure(t: Tables) -> DataFrame:
    storages = F.array(*(F.struct(F.lit(name).alias("storage"), F.lit(n).alias("n")) for name, n in (("pairtree", 1), ("objectstore", 2))))
    number = F.col("id").cast("long")
    steps = (("stage", number % 5 != F.col("n")), ("validate_zip", number % 7 != 0), ("move", number % 11 != F.col("n")))
    placed = t.feed_audit.withColumn("s", F.explode(storages))
    return placed.select("namespace", "id", "s.storage", "s.n").select("namespace", "id", "storage", machine.first_failure(*steps).alias("failed"))


@query("metric_totals", "select metric, concat('kind=\"', cast(event_id % 2 as string), '\",namespace=\"', namespace, '\"') as labels, cast(sum(amount) as bigint) as value from metric_events where amount >= 0 group by 1, 2", "metric_events")
def metric_totals(t: Tables) -> DataFrame:
    return telemetry.totals(t.metric_events, {"Namespace": F.col("namespace"), "kind": F.col("event_id") % 2})


@query("metric_exposition", "select concat(metric, '{namespace=\"', namespace, '\"} ', cast(cast(sum(amount) as bigint) as string)) as line from metric_events where amount >= 0 group by metric, namespace", "metric_events")
def metric_exposition(t: Tables) -> DataFrame:
    return telemetry.exposition(telemetry.totals(t.metric_events, {"namespace": F.col("namespace")}))


@query("metric_value", "select cast(sum(amount) as bigint) as value from metric_events where metric = 'ingest_click_seconds_total' and namespace = 'ns1' and amount >= 0 union all select 0", "metric_events")
def metric_value(t: Tables) -> DataFrame:
    lines = telemetry.exposition(telemetry.totals(t.metric_events, {"namespace": F.col("namespace")}))
    return telemetry.read_value(lines, 'ingest_click_seconds_total{namespace="ns1"}').union(telemetry.read_value(lines, "ingest_click"))


@query("metric_buckets", "select case when amount <= 10 then 10 when amount <= 50 then 50 when amount <= 100 then 100 end as bucket, count(*) as n from metric_events group by 1", "metric_events")
def metric_buckets(t: Tables) -> DataFrame:
    return t.metric_events.groupBy(telemetry.buckets(F.col("amount"), [10, 50, 100]).alias("bucket")).agg(F.count("*").alias("n"))


@query("log_rows", "select event_id, left(concat(repeat(detail, 30), message), 255) as detail from feed_log", "feed_log")
def log_rows_query(t: Tables) -> DataFrame:
    return log_rows(t.feed_log.withColumn("detail", F.concat(F.repeat("detail", 30), "message"))).select("event_id", "detail")


@query("log_lines", "select event_id, concat(message, chr(9), 'field: ', case when field is null then '(null)' when field = '' then '(empty)' else field end, chr(9), 'operation: ', operation) as line from feed_log", "feed_log")
def log_lines(t: Tables) -> DataFrame:
    return t.feed_log.select("event_id", telemetry.log_line(F.col("message"), {"field": F.col("field"), "operation": F.col("operation")}).alias("line"))


@query("log_unrepeated", """
  with b as (select *, lag(message) over (partition by namespace, id order by logged_at, event_id) as before from feed_log)
  select event_id, message from b where before is distinct from message""", "feed_log")  # fmt: skip
def log_unrepeated(t: Tables) -> DataFrame:
    return telemetry.unrepeated(t.feed_log, ["namespace", "id"], ["logged_at", "event_id"], "message").select("event_id", "message")


@query("audit_details", "select event_id, concat('field: ', coalesce(field, 'none'), chr(9), 'operation: ', operation) as details from feed_log", "feed_log")
def audit_details(t: Tables) -> DataFrame:
    details = F.create_map(F.lit("operation"), F.col("operation"), F.lit("field"), F.coalesce("field", F.lit("none")))
    return t.feed_log.select("event_id", detail_text(details).alias("details"))


@query("stream_status_counts", "select event_type, user_id % 5 as shard, count(*) as n from events group by 1, 2")
def stream_status_counts(t: Tables) -> DataFrame:
    stream = jobs.table_stream(t.spark, t.sf_dir, "events").withColumn("shard", F.col("user_id") % 5)
    return jobs.final_counts(stream, ["event_type", "shard"])


IA = ", ".join(f"('{a}', '{c}', '{d}')" for a, _, c, d in machine.STAGES["ia"])


@query("stream_machine", f"""
  with recursive stages(status, good, bad) as (select * from (values {IA}) v(status, good, bad)),
  e as (select user_id as volume, event_type <> 'error' as ok, row_number() over (partition by user_id order by event_id) as r from events),
  run(volume, r, status, failures) as (
    select distinct user_id, cast(0 as bigint), 'ready', 0 from events
    union all
    select volume, r, case when released then 'ready' else status end, case when released then 0 else failures end from (
      select x.*, x.status in ({RELEASED}) as released from (
        select run.volume, e.r, case when s.status is null then 'punted' when e.ok then s.good when run.failures >= 5 then 'punted' else coalesce(nullif(s.bad, ''), 'punted') end as status, run.failures + case when e.ok then 0 else 1 end as failures
        from run join e on e.volume = run.volume and e.r = run.r + 1 left join stages s on s.status = run.status) x))
  select volume, arg_max(status, r) as status, cast(arg_max(failures, r) as bigint) as failure_count, cast(max(r) as bigint) as steps from run group by volume""")  # fmt: skip
def stream_machine(t: Tables) -> DataFrame:
    stream = jobs.table_stream(t.spark, t.sf_dir, "events")
    return jobs.final_states(stream.select(F.col("user_id").alias("volume"), "event_id", (F.col("event_type") != "error").alias("success")))


@query("stream_outcomes", """
  select 'outcome' as sink, cast(user_id as varchar) as key, case when count(*) filter (event_type = 'error') > 0 then 'failed' else 'done' end as state, count(*) as n from events group by user_id
  union all select 'metric', concat('ingest_', event_type, '_seconds_total'), null, cast(sum(cast(floor(coalesce(value, 0)) as bigint)) as bigint) from events group by event_type
  union all select 'bucket', event_type, case when floor(coalesce(value, 0)) <= 10 then '10' when floor(coalesce(value, 0)) <= 100 then '100' else 'inf' end, count(*) from events group by 2, 3""")  # fmt: skip
def stream_outcomes(t: Tables) -> DataFrame:
    """A stream of events to three sinks, each exactly once: every volume's outcome, counters, and a histogram of seconds."""
    amount = F.floor(F.coalesce("value", F.lit(0))).cast("long")
    bucket = F.when(amount <= 10, "10").when(amount <= 100, "100").otherwise("inf")
    sinks = {
        "outcome": lambda b: b.groupBy(F.col("user_id").cast("string").alias("key")).agg(F.bool_or(F.col("event_type") == "error").alias("failed"), F.count("*").alias("n")),
        "metric": lambda b: b.groupBy(F.concat(F.lit("ingest_"), "event_type", F.lit("_seconds_total")).alias("key")).agg(F.sum(amount).alias("n")),
        "bucket": lambda b: b.groupBy(F.col("event_type").alias("key"), bucket.alias("state")).agg(F.count("*").alias("n")),
    }
    folder = jobs.shared_folder(t.spark)
    ledger.run(jobs.table_stream(t.spark, t.sf_dir, "events"), folder, sinks)
    rows = {k: ledger.taken(t.spark, folder, k) for k in sinks}
    outcome = rows["outcome"].groupBy("key").agg(F.when(F.bool_or("failed"), "failed").otherwise("done").alias("state"), F.sum("n").alias("n"))
    metric = rows["metric"].groupBy("key").agg(F.sum("n").alias("n")).select("key", F.lit(None).cast("string").alias("state"), "n")
    buckets = rows["bucket"].groupBy("key", "state").agg(F.sum("n").alias("n"))
    named = [df.select(F.lit(k).alias("sink"), "key", "state", "n") for k, df in {"outcome": outcome, "metric": metric, "bucket": buckets}.items()]
    return named[0].union(named[1]).union(named[2])


PATIENCE, LATE = 6 * 3600, 3600  # seconds


@query("stream_deliveries", f"""
  with e as (select user_id as m, user_id % 3 + 1 as priority, epoch_us(ts) as us, case when event_type in ('click', 'view') then 0 when event_type = 'signup' then 1 else 2 end as k from events),
  n as (select *, coalesce(sum(case when k = 2 then 1 else 0 end) over (partition by m order by us, k rows between unbounded preceding and 1 preceding), 0) as turn from e),
  turns as (select m, turn, min(us) filter (k = 0) as opened, min(us) filter (k = 2) as closed from n group by m, turn),
  hands as (select m, turn, opened as us, closed from turns where opened is not null union all select n.m, n.turn, n.us, t.closed from n join turns t on t.m = n.m and t.turn = n.turn where n.k = 1 and n.us >= t.opened),
  seen as (select m, priority, greatest(max(us), (select max(us) // 1000 * 1000 - {LATE}000000 from e)) as us from e group by m, priority),
  spans as (select h.m, seen.priority, h.turn, h.us, coalesce(lead(h.us) over (partition by h.m, h.turn order by h.us), h.closed, seen.us) as until from hands h join seen on seen.m = h.m),
  handed as (select m, priority, turn, us + unnest(generate_series(0, greatest(0, (until - us - 1) // {PATIENCE}000000))) * {PATIENCE}000000 as micros from spans)
  select m as message, cast(priority as bigint) as priority, row_number() over (partition by m, turn order by micros) as attempt, cast(micros as bigint) as micros,
    row_number() over (partition by micros // 3600000000 order by priority desc, micros, m) as place from handed""")  # fmt: skip
def stream_deliveries(t: Tables) -> DataFrame:
    """Every user's message over a stream of events: handed out by click or view, lost by signup, finished by purchase, rejected by error; its place in its hour by priority."""
    kind = F.when(F.col("event_type").isin("click", "view"), "queued").when(F.col("event_type") == "signup", "lost").when(F.col("event_type") == "purchase", "finished").otherwise("rejected")
    stream = jobs.table_stream(t.spark, t.sf_dir, "events").select(F.col("user_id").alias("message"), kind.alias("kind"), (F.col("user_id") % 3 + 1).alias("priority"), F.col("ts").cast("timestamp").alias("at"))
    handed = delivery.handed_out(stream, PATIENCE, f"{LATE} seconds").withColumn("hour", F.expr("micros div 3600000000")).withColumn("arrival", F.struct("micros", "message"))
    return queueing.delivery_places(handed, "hour").select("message", F.col("priority").cast("long").alias("priority"), F.col("attempt").cast("long").alias("attempt"), "micros", F.col("place").cast("long").alias("place"))
