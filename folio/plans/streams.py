"""Streaming queries over the events, and the SQL of their batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import metrics as m
from folio.operators.chunking import chunk_fixed
from folio.plans import bindings as b
from folio.plans.bindings import MESSAGES, STAGES, sql
from folio.plans.registry import query, table
from folio.streaming import streams as st


def _events(spark, d):
    """The task binding over a stream of the events table."""
    raw = table(spark, d, "events")
    e = st.read_events(spark, f"{d}/events*.parquet", raw.schema)
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % n + 1).cast("int"))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "started").otherwise("completed")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("document_id"), (F.col("user_id") % 10).alias("batch_id"), pick(STAGES, 6).alias("stage"),
        status.alias("status"), F.when(F.col("event_type") == "error", pick(MESSAGES, 8)).alias("message"), F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.get_json_object("props", "$.k").cast("long").alias("k"))


_W = "count(*) as runs, count(*) filter (where status = 'failed') as failures, sum(cents) as total_cents from tasks"


@query("stream_minute_metrics", sql("tasks", f"select date_trunc('minute', ts) as start, stage, {_W} group by 1, 2"))
def stream_minute_metrics(spark, d):
    return st.run(st.windowed(_events(spark, d), "1 minute", None, "stage"), "complete", "minutes")


@query("stream_hourly_events", sql("tasks", f"select date_trunc('hour', ts) as start, stage, {_W} group by 1, 2"))
def stream_hourly_events(spark, d):
    return st.run(st.windowed(_events(spark, d), "1 hour", None, "stage"), "complete", "hours")


@query("stream_daily_stage_counts", sql("tasks", f"select date_trunc('day', ts) as start, stage, {_W} group by 1, 2"))
def stream_daily_stage_counts(spark, d):
    return st.run(st.windowed(_events(spark, d), "1 day", None, "stage"), "complete", "days")


@query("stream_error_windows", sql("tasks", """, s as (select *, 24 as hours, date_trunc('hour', ts) - to_hours(back) as start from (select *, unnest(range(0, 24)) as back from tasks)
    union all select *, 1, time_bucket(interval 5 minute, ts) - to_minutes(5 * back) from (select *, unnest(range(0, 12)) as back from tasks))
    select hours, start, stage, count(*) as runs, count(*) filter (where status = 'failed') as failures, sum(cents) as total_cents from s group by 1, 2, 3"""))
def stream_error_windows(spark, d):
    """Windows of a day every hour, and of an hour every five minutes."""
    day = st.run(st.windowed(_events(spark, d), "24 hours", "1 hour", "stage"), "complete", "sliding")
    hour = st.run(st.windowed(_events(spark, d), "1 hour", "5 minutes", "stage"), "complete", "sliding")
    return day.withColumn("hours", F.lit(24)).unionByName(hour.withColumn("hours", F.lit(1)))


@query("stream_batch_progress", sql("tasks", """, l as (select batch_id, document_id, arg_max(status, struct_pack(a := ts, b := event_id)) as status from tasks group by 1, 2)
    select batch_id, count(*) as total, count(*) filter (where status = 'completed') as completed, count(*) filter (where status = 'failed') as failed,
    count(*) filter (where status in ('completed', 'failed')) >= count(*) as finished from l group by 1"""))
def stream_batch_progress(spark, d):
    """Documents of each batch by their latest status; a batch is finished once all have ended."""
    latest = st.run(st.latest_states(_events(spark, d)), "complete", "progress")
    good, bad = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    return latest.groupBy("batch_id").agg(F.count("*").alias("total"), good.alias("completed"), bad.alias("failed"), (good + bad >= F.count("*")).alias("finished"))


_STATE = "case when status = 'failed' then 'failed' when k % 11 = 0 then 'cancelled' when k % 7 = 0 then 'retrying' else status end"


def _states(events):
    """Events with a state told from their status and k."""
    state = F.when(F.col("status") == "failed", "failed").when(F.col("k") % 11 == 0, "cancelled").when(F.col("k") % 7 == 0, "retrying").otherwise(F.col("status"))
    return events.withColumn("state", state)


@query("stream_status_fold", sql("tasks", f""", e as (select *, {_STATE} as state from tasks),
    f as (select document_id, arg_max(state, struct_pack(a := ts, b := event_id)) as latest, arg_max(stage, struct_pack(a := ts, b := event_id)) as last_stage,
    coalesce(list_sort(list(distinct stage) filter (where state = 'completed')), []) as done, count(*) filter (where state = 'failed') as error_count, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us from e group by 1)
    select document_id, case when latest in ('failed', 'cancelled', 'retrying') then latest when latest = 'completed' and last_stage = 'relationship_building' then 'completed'
    when len(done) > 0 or latest = 'started' then 'in_progress' else 'pending' end as overall_status, coalesce(array_to_string(done, ','), '') as stages_completed, error_count, first_us, last_us from f"""))
def stream_status_fold(spark, d):
    changes = st.run(st.status_fold(_states(_events(spark, d))), "update", "fold")  # the last change is the status
    return changes.groupBy("document_id").agg(F.max_by(F.struct(*changes.columns[1:]), F.struct("last_us", "error_count", F.length("stages_completed"))).alias("r")).select("document_id", "r.*")


@query("stream_dedup", sql("chunks", """, k as (select distinct document_id, chunk_index, md5(chunk_text) as digest from chunks)
    select 1 as delivery, count(*) as served, count(distinct digest) as texts from k union all select 4, count(*), count(distinct digest) from k where document_id % 5 = 0"""))
def stream_dedup(spark, d):
    """Chunks are served once, however often they are delivered: the key is the
    chunk and its text's hash.

    Five deliveries: all chunks; all again half an hour later; one document in
    three five hours later, while state still knows them; one in five after the
    watermark has let go of them, which are served again; and late copies.
    """
    chunks = b.chunks(spark, d).select("document_id", "chunk_index", F.md5("chunk_text").alias("digest"))
    sent = lambda n, minutes, every: chunks.where(F.col("document_id") % every == 0).select("*", F.lit(n).alias("delivery"), F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minutes)).alias("ts"))
    deliveries = [sent(1, 0, 1), sent(2, 30, 1), sent(3, 300, 3), sent(4, 310, 5), sent(5, 60, 1)]
    keys = ["document_id", "chunk_index", "digest"]
    once = st.delivered(deliveries, lambda rows: st.first_deliveries(rows, keys).select(*keys, "delivery"), "append", "dedup")
    return once.groupBy("delivery").agg(F.count("*").alias("served"), F.countDistinct("digest").alias("texts"))


@query("event_log_sink", sql("tasks", "select stage, cast(ts as date) as day, count(*) as n from tasks group by 1, 2"))
def event_log_sink(spark, d):
    from folio.sources.storage import shared_path

    path, state = shared_path(spark, "log"), shared_path(spark, "log-state")
    rows = _events(spark, d).select("event_id", "document_id", "status", "stage", F.to_date("ts").alias("day"))
    sink = rows.writeStream.format("json").partitionBy("stage", "day").option("path", path).option("checkpointLocation", state).option("maxRecordsPerFile", 100_000)
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, document_id long, status string, stage string, day date").json(path).groupBy("stage", "day").agg(F.count("*").alias("n"))


@query("warning_streak", sql("tasks", """, f as (select *, case when ts - lag(ts) over (partition by status order by ts, event_id) < interval 5 minute then 0 else 1 end as fresh from tasks where status <> 'completed'),
    s as (select *, sum(fresh) over (partition by status order by ts, event_id rows unbounded preceding) as session from f) select status, min(ts) as start, count(*) as events from s group by status, session having count(*) >= 3"""))
def warning_streak(spark, d):
    """Three or more warnings of a kind, each within five minutes of the one before."""
    return st.run(st.streaks(_events(spark, d).where("status <> 'completed'"), "5 minutes", 3, "status"), "complete", "streaks")


@query("failure_gate", sql("tasks", """, g as (select document_id, max(struct_pack(a := ts, b := event_id)) filter (where status = 'completed') as good from tasks group by 1),
    f as (select document_id, count(*) filter (where status = 'failed' and (good is null or struct_pack(a := ts, b := event_id) > good)) as failures,
    coalesce(epoch_us(max(ts) filter (where status = 'failed' and (good is null or struct_pack(a := ts, b := event_id) > good))), 0) as last_us from tasks join g using (document_id) group by 1)
    select document_id, failures, last_us, failures >= 3 and (select epoch_us(max(ts)) from tasks) - last_us <= 86400000000 as blocked from f"""))
def failure_gate(spark, d):
    """Documents with three failures in a row, the last in the day before the
    latest event; every second event comes a delivery late, up to ten days."""
    tasks = b.tasks(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    due = F.floor((F.dayofmonth("ts") - 1) / 10) + F.col("event_id") % 2
    deliveries = [tasks.where(due == n).select("event_id", "document_id", "status", "ts") for n in range(5)]
    changes = st.delivered(deliveries, lambda rows: st.failure_gate(rows, "40 days"), "update", "gate")
    as_of = b.tasks(spark, d).agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("as_of_us"))
    return st.blocked(st.latest_gates(changes), as_of, seconds=86_400)


@query("batch_progress", sql("tasks", """, l as (select batch_id, document_id, arg_max(status, struct_pack(a := ts, b := event_id)) as status, arg_max(stage, struct_pack(a := ts, b := event_id)) as stage from tasks group by 1, 2),
    t as (select batch_id, epoch(max(ts)) - epoch(min(ts)) as seconds from tasks group by 1),
    n as (select batch_id, count(*) as total, count(*) filter (where status = 'completed') as completed, count(*) filter (where status = 'failed') as failed from l group by 1),
    s as (select batch_id, stage, count(*) as documents from l group by 1, 2)
    select batch_id, stage, documents, total, completed, failed, (completed + failed) * 100.0 / total as percent, case when completed > 0 then round(seconds / 60.0 / completed * (total - completed - failed), 3) end as eta_minutes
    from s join n using (batch_id) join t using (batch_id)"""))
def batch_progress(spark, d):
    """Batches by the latest stage and status of their documents, with the time
    that is left at the pace so far."""
    tasks = b.tasks(spark, d)
    at = F.struct("ts", "event_id")
    latest = tasks.groupBy("batch_id", "document_id").agg(F.max_by("status", at).alias("status"), F.max_by("stage", at).alias("stage"))
    good, bad = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    n = latest.groupBy("batch_id").agg(F.count("*").alias("total"), good.alias("completed"), bad.alias("failed"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    time = tasks.groupBy("batch_id").agg(((F.max(us) - F.min(us)) / 1e6).alias("seconds"))
    rows = latest.groupBy("batch_id", "stage").agg(F.count("*").alias("documents")).join(n, "batch_id").join(time, "batch_id")
    left = F.col("total") - F.col("completed") - F.col("failed")
    eta = F.when(F.col("completed") > 0, F.round(F.col("seconds") / 60.0 / F.col("completed") * left, 3))
    return rows.select("batch_id", "stage", "documents", "total", "completed", "failed", ((F.col("completed") + F.col("failed")) * 100.0 / F.col("total")).alias("percent"), eta.alias("eta_minutes"))


@query("error_rates_by_stage", sql("tasks", """, w as (select max(ts) as as_of from tasks), e as (select stage, message, count(*) as n from tasks where status = 'failed' group by 1, 2),
    c as (select stage, string_agg(message || '=' || n, '; ' order by n desc, message) as common from (select *, row_number() over (partition by stage order by n desc, message) as rn from e) where rn <= 3 group by 1),
    r as (select stage, count(*) filter (where status = 'failed' and ts > as_of - interval 1 hour) as last_hour, count(*) filter (where status = 'failed' and ts > as_of - interval 24 hour) as last_day,
    count(*) filter (where status = 'failed') * 100.0 / count(*) as rate from tasks, w group by 1)
    select stage, last_hour, last_day, rate, case when last_hour * 24 > last_day then 'rising' when last_hour * 24 < last_day then 'falling' else 'steady' end as trend, common,
    rate = (select max(rate) from r) as highest from r left join c using (stage)"""))
def error_rates_by_stage(spark, d):
    """Failures of the last hour and day, their trend, the three most common
    messages, and which stage has the highest rate."""
    tasks = b.tasks(spark, d)
    as_of = F.broadcast(tasks.agg(F.max("ts").alias("as_of")))  # one row
    failed = F.col("status") == "failed"
    recent = lambda h: F.count_if(failed & (F.col("ts") > F.col("as_of") - F.expr(f"INTERVAL {h} HOURS")))
    rows = tasks.join(as_of).groupBy("stage").agg(recent(1).alias("last_hour"), recent(24).alias("last_day"), m.rate(F.count_if(failed), F.count("*")).alias("rate"))
    n = tasks.where(failed).groupBy("stage", "message").agg(F.count("*").alias("n"))
    listed = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "message"))), 1, 3)  # of as many messages as there are kinds
    common = n.groupBy("stage").agg(F.array_join(F.transform(listed, lambda v: F.concat_ws("=", v["message"], (-v["less"]).cast("string"))), "; ").alias("common"))
    pace = F.col("last_hour") * 24
    trend = F.when(pace > F.col("last_day"), "rising").when(pace < F.col("last_day"), "falling").otherwise("steady")
    top = F.broadcast(rows.agg(F.max("rate").alias("top")))  # one row
    return rows.join(common, "stage", "left").join(top).select("stage", "last_hour", "last_day", "rate", trend.alias("trend"), "common", (F.col("rate") == F.col("top")).alias("highest"))
