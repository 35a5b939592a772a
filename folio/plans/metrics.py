"""Aggregate queries (events, batches, entities, files) and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.operators import metrics as m
from folio.operators import rules
from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table



def done():
    return F.count_if(F.col("status") == "completed")


def failed():
    return F.count_if(F.col("status") == "failed")


LATE = "select max(ts) as as_of from tasks"


@query("entity_type_distribution", sql("mentions", """select source, entity_type, n, percent, percent < 2 as rare from (
    select source, entity_type, count(*) as n, count(*) * 100.0 / sum(count(*)) over (partition by source) as percent
    from mentions group by 1, 2)"""))
def entity_type_distribution(spark, d):
    return m.type_distribution(b.mentions(spark, d), ["source"])


@query("entity_type_entropy", sql("mentions", """select source, count(*) as types, round(sum(-p * log2(p)), 6) as entropy from (
    select source, entity_type, count(*) * 1.0 / sum(count(*)) over (partition by source) as p from mentions group by 1, 2) group by 1"""))
def entity_type_entropy(spark, d):
    return m.shannon_entropy(b.mentions(spark, d), ["source"], "entity_type")


@query("pipeline_status_counts", sql("tasks files", """select 'status' as dimension, status as value, count(*) as n,
    sum(cents) filter (where status = 'completed') * 1.0 / count(*) filter (where status = 'completed') as avg_completed_cents from tasks group by 2
    union all select 'stage', stage, count(*), sum(cents) filter (where status = 'completed') * 1.0 / count(*) filter (where status = 'completed') from tasks group by 2
    union all select 'file_type', coalesce(nullif(regexp_extract(path, '\\.([A-Za-z0-9]{1,5})$', 1), ''), 'none'), count(*), null from files group by 2"""))
def pipeline_status_counts(spark, d):
    paid = F.when(F.col("status") == "completed", F.col("cents"))
    rows = m.grouped_summary(b.tasks(spark, d), "status", "stage", measures=[F.count("*").alias("n"), F.when(F.count(paid) > 0, F.sum(paid) / F.count(paid)).alias("avg_completed_cents")])
    suffix = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1)
    kinds = b.files(spark, d).groupBy(F.when(suffix != "", suffix).otherwise("none").alias("value")).agg(F.count("*").alias("n"))
    kinds = kinds.select(F.lit("file_type").alias("dimension"), "value", "n", F.lit(None).cast("double").alias("avg_completed_cents"))
    return rows.where("dimension <> 'total'").select(*kinds.columns).union(kinds)


@query("status_percentages", sql("tasks", "select status, count(*) as n, count(*) * 100.0 / sum(count(*)) over () as percent from tasks group by 1"))
def status_percentages(spark, d):
    return m.status_percentages(b.tasks(spark, d))


@query("project_stats_view", sql("tasks", """select project_id, count(distinct document_id) as documents,
    count(distinct case when status = 'completed' then document_id end) as completed,
    count(distinct case when status = 'failed' then document_id end) as failed, max(ts) as last_update from tasks group by 1"""))
def project_stats_view(spark, d):
    of = lambda s: F.countDistinct(F.when(F.col("status") == s, F.col("document_id")))
    return b.tasks(spark, d).groupBy("project_id").agg(
        F.countDistinct("document_id").alias("documents"), of("completed").alias("completed"), of("failed").alias("failed"), F.max("ts").alias("last_update"))


@query("resolution_quality_view", sql("scored", """select source, count(distinct canonical_id) as entities,
    sum(confidence) / count(*) as avg_confidence, count(*) as mentions,
    count(distinct canonical_id) filter (where confidence >= 90) as sure,
    count(distinct canonical_id) filter (where confidence < 70) as unsure from scored group by 1"""))
def resolution_quality_view(spark, d):
    sure, c = F.col("confidence") >= 90, F.col("canonical_id")
    return b.scored(spark, d).groupBy("source").agg(
        F.countDistinct("canonical_id").alias("entities"), (F.sum("confidence") / F.count("*")).alias("avg_confidence"), F.count("*").alias("mentions"),
        F.countDistinct(F.when(sure, c)).alias("sure"), F.countDistinct(F.when(F.col("confidence") < 70, c)).alias("unsure"))


@query("throughput_view", sql("tasks", """select date_trunc('hour', ts) as hour, stage, count(*) as runs, sum(cents) / count(*) as avg_cents,
    round(quantile_cont(cents, 0.95), 2) as p95_cents, count(*) filter (where status = 'failed') as failures from tasks group by 1, 2"""))
def throughput_view(spark, d):
    return b.tasks(spark, d).groupBy(F.date_trunc("hour", "ts").alias("hour"), "stage").agg(
        F.count("*").alias("runs"), (F.sum("cents") / F.count("*")).alias("avg_cents"), F.round(F.percentile("cents", F.lit(0.95)), 2).alias("p95_cents"), failed().alias("failures"))


@query("pipeline_summary_mv", sql("tasks", """select project_id, status, stage, count(*) as runs, sum(cents) / count(*) as avg_cents,
    max(ts) as last_update from tasks group by 1, 2, 3"""))
def pipeline_summary_mv(spark, d):
    return b.tasks(spark, d).groupBy("project_id", "status", "stage").agg(
        F.count("*").alias("runs"), (F.sum("cents") / F.count("*")).alias("avg_cents"), F.max("ts").alias("last_update"))


@query("entity_statistics_mv", sql("scored", """select source, entity_type, count(distinct canonical_id) as entities, count(*) as mentions,
    sum(confidence) / count(*) as avg_confidence, count(*) filter (where confidence >= 90) as verified from scored group by 1, 2"""))
def entity_statistics_mv(spark, d):
    return b.scored(spark, d).groupBy("source", "entity_type").agg(
        F.countDistinct("canonical_id").alias("entities"), F.count("*").alias("mentions"), (F.sum("confidence") / F.count("*")).alias("avg_confidence"),
        F.count_if(F.col("confidence") >= 90).alias("verified"))


@query("hourly_metrics_rollup", sql("tasks", """, e as (select cast(ts as date) as day, hour(ts) as hour, project_id, stage, message, count(*) as n
    from tasks where message is not null group by all), j as (select day, hour, project_id, stage,
    string_agg(message || '=' || n, '; ' order by message || '=' || n) as errors from e group by all)
    select t.*, j.errors from (select cast(ts as date) as day, hour(ts) as hour, project_id, stage,
    count(*) filter (where status = 'completed') as processed, count(*) filter (where status = 'failed') as failed,
    sum(cents) / count(*) as avg_cents, round(quantile_cont(cents, 0.95), 2) as p95_cents from tasks group by 1, 2, 3, 4) t
    left join j using (day, hour, project_id, stage)"""))
def hourly_metrics_rollup(spark, d):
    return m.hourly_rollup(b.tasks(spark, d))


@query("batch_metrics", sql("batches items", """select priority, count(distinct batch_id) as batches, count(*) as documents,
    count(*) filter (where i.status = 'completed') as completed, count(*) filter (where i.status = 'failed') as failed
    from batches join items i using (batch_id) group by rollup (priority)"""))
def batch_metrics(spark, d):
    rows = b.batches(spark, d).select("batch_id", "priority").join(b.items(spark, d), "batch_id")
    return rows.rollup("priority").agg(F.countDistinct("batch_id").alias("batches"), F.count("*").alias("documents"), done().alias("completed"), failed().alias("failed"))


_STAGE = """count(*) as runs, sum(cents) as total_cents, sum(cents) / count(*) as avg_cents,
    coalesce(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*) filter (where status in ('completed', 'failed')), 0), 0) as success_rate"""


@query("stage_metrics", sql("tasks", f"select stage, {_STAGE} from tasks group by 1"))
def stage_metrics(spark, d):
    return m.stage_metrics(b.tasks(spark, d))


@query("performance_report", sql("tasks", f"select batch_id, stage, {_STAGE} from tasks group by 1, 2"))
def performance_report(spark, d):
    return m.stage_metrics(b.tasks(spark, d), "batch_id")


@query("error_summary", sql("tasks", f""", e as (select * from tasks where status = 'failed' and ts > (select as_of from ({LATE})) - interval 240 hour)
    select case when grouping(message) = 0 then 'message' when grouping(stage) = 0 then 'stage' else 'total' end as dimension,
    coalesce(message, stage) as value, count(*) as n from e group by grouping sets ((message), (stage), ())
    union all select 'sample', stage || ': ' || message, event_id from (select * from e order by ts desc, event_id desc limit 20)"""))
def error_summary(spark, d):
    """Counts, and the 20 latest failures as samples (n is their event)."""
    tasks = m.within_hours(b.tasks(spark, d), 240).where("status = 'failed'")
    latest = tasks.orderBy(F.desc("ts"), F.desc("event_id")).limit(20)
    samples = latest.select(F.lit("sample").alias("dimension"), F.concat_ws(": ", "stage", "message").alias("value"), F.col("event_id").alias("n"))
    return m.grouped_summary(tasks, "message", "stage", measures=[F.count("*").alias("n")]).select(*samples.columns).union(samples)


@query("batch_result_summary", sql("items", """select batch_id, count(*) as total, count(*) filter (where status = 'completed') as completed,
    count(*) filter (where status = 'failed') as failed,
    coalesce(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*) filter (where status in ('completed', 'failed')), 0), 0) as success_rate,
    array_to_string(list_slice(list_sort(list(cast(document_id as varchar)) filter (where status = 'failed')), 1, 10), ',') as first_errors
    from items group by 1"""))
def batch_result_summary(spark, d):
    items = b.items(spark, d)
    found = items.groupBy("batch_id").agg(
        F.count("*").alias("total"), done().alias("completed"), failed().alias("failed"), m.rate(done(), done() + failed()).alias("success_rate"))
    errors = items.where("status = 'failed'").select("batch_id", F.col("document_id").cast("string").alias("document_id"))
    return found.join(m.listed_first(errors, ["batch_id"], "document_id", 10, "first_errors"), "batch_id", "left")


@query("campaign_progress", sql("batches", """select project_id, count(*) as batches, count(*) filter (where status = 'completed') as completed,
    count(*) filter (where status = 'completed') * 100.0 / count(*) as percent,
    case when count(*) filter (where status = 'completed') = count(*) then 'completed'
         when count(*) filter (where status <> 'pending') > 0 then 'in_progress' else 'pending' end as campaign_status from batches group by 1"""))
def campaign_progress(spark, d):
    state = F.when(done() == F.count("*"), "completed").when(F.count_if(F.col("status") != "pending") > 0, "in_progress").otherwise("pending")
    return b.batches(spark, d).groupBy("project_id").agg(
        F.count("*").alias("batches"), done().alias("completed"), m.rate(done(), F.count("*")).alias("percent"), state.alias("campaign_status"))


@query("batch_performance_24h", sql("batches items", """, w as (select max(created_at) as as_of from batches), r as (select batches.* from batches, w where created_at > as_of - interval 24 hour),
    n as (select batch_id, count(*) as documents, count(*) filter (where status = 'failed') as failed from items where batch_id in (select batch_id from r) group by 1)
    select count(*) as batches, count(*) filter (where status = 'completed') as completed, count(*) filter (where failed > 0) as with_failures, sum(cents) * 1.0 / count(*) as avg_cents,
    sum(documents) * 1.0 / count(*) as documents_per_batch, count(*) filter (where status = 'completed') * 100.0 / count(*) as success_rate, sum(documents) / 24.0 as documents_per_hour
    from r left join n using (batch_id)"""))
def batch_performance_24h(spark, d):
    rows = m.within_hours(b.batches(spark, d), 24, ts="created_at")
    n = b.items(spark, d).groupBy("batch_id").agg(F.count("*").alias("documents"), failed().alias("failed"))
    documents = F.sum("documents")
    return rows.join(n, "batch_id", "left").agg(
        F.count("*").alias("batches"), done().alias("completed"), F.count_if(F.col("failed") > 0).alias("with_failures"), (F.sum("cents") / F.count("*")).alias("avg_cents"),
        (documents / F.count("*")).alias("documents_per_batch"), (done() * 100.0 / F.count("*")).alias("success_rate"), (documents / 24.0).alias("documents_per_hour"))


@query("active_batches", sql("batches items", """, p as (select *, row_number() over (partition by status order by created_at desc, batch_id) as rn from batches where status in ('processing', 'completed')),
    n as (select batch_id, count(*) filter (where status = 'completed') * 100.0 / count(*) as percent from items group by 1)
    select batch_id, status, priority, created_at, coalesce(percent, 0) as percent from p left join n using (batch_id) where rn <= 10"""))
def active_batches(spark, d):
    """The ten newest batches in progress and the ten newest completed ones."""
    batches = b.batches(spark, d)
    newest = lambda s: batches.where(F.col("status") == s).orderBy(F.desc("created_at"), "batch_id").limit(10)
    rows = newest("processing").union(newest("completed"))
    n = b.items(spark, d).groupBy("batch_id").agg((done() * 100.0 / F.count("*")).alias("percent"))
    return rows.join(n, "batch_id", "left").select("batch_id", "status", "priority", "created_at", F.coalesce("percent", F.lit(0.0)).alias("percent"))


@query("campaign_report", sql("items batches", """select b.project_id, count(*) as documents,
    coalesce(count(*) filter (where i.status = 'completed') * 100.0 / nullif(count(*) filter (where i.status <> 'pending'), 0), 0) as success_rate,
    sum(size_mb) as size_mb, count(distinct batch_id) as batches, sum(i.cents) * 1.0 / count(*) as cents_per_document, count(*) * 3600.0 / sum(i.cents) as documents_per_hour,
    count(*) filter (where size_mb between 1 and 25) as size_passed, count(*) filter (where i.cents > 100000) as value_passed,
    count(*) filter (where size_mb between 1 and 25 and i.cents > 100000 and i.status = 'completed') as all_passed
    from items i join batches b using (batch_id) group by 1"""))
def campaign_report(spark, d):
    """Success, time and the counts of documents that pass each validation; cents
    stand for seconds."""
    rows = b.items(spark, d).join(b.batches(spark, d).select("batch_id", "project_id"), "batch_id")
    sized, valued = F.col("size_mb").between(1, 25), F.col("cents") > 100000
    return rows.groupBy("project_id").agg(
        F.count("*").alias("documents"), m.rate(done(), done() + failed()).alias("success_rate"), F.sum("size_mb").alias("size_mb"), F.countDistinct("batch_id").alias("batches"),
        (F.sum("cents") / F.count("*")).alias("cents_per_document"), (F.count("*") * 3600.0 / F.sum("cents")).alias("documents_per_hour"), F.count_if(sized).alias("size_passed"),
        F.count_if(valued).alias("value_passed"), F.count_if(sized & valued & (F.col("status") == "completed")).alias("all_passed"))


@query("processing_summary", sql("tasks", """select batch_id, coalesce(stage, 'all') as stage, count(distinct document_id) as documents,
    count(distinct case when status = 'completed' and t.stage = 'relationship_building' then document_id end) as succeeded,
    count(distinct case when status = 'failed' then document_id end) as failed,
    min(cents) as min_cents, sum(cents) * 1.0 / count(*) as avg_cents, max(cents) as max_cents, sum(cents) as total_cents,
    count(distinct message) as error_types, count(distinct document_id) * 3600.0 / sum(cents) as throughput,
    coalesce(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*) filter (where status in ('completed', 'failed')), 0), 0) as quality
    from (select *, stage as st from tasks) t group by grouping sets ((batch_id, stage), (batch_id))""".replace("t.stage", "st")))
def processing_summary(spark, d):
    """Each batch (stage `all`) and its stages; cents stand for seconds."""
    doc = F.col("document_id")
    last = (F.col("status") == "completed") & (F.col("st") == "relationship_building")
    rows = b.tasks(spark, d).withColumn("st", F.col("stage")).groupingSets([["batch_id", "stage"], ["batch_id"]], "batch_id", "stage")
    return rows.agg(
        F.countDistinct("document_id").alias("documents"), F.countDistinct(F.when(last, doc)).alias("succeeded"),
        F.countDistinct(F.when(F.col("status") == "failed", doc)).alias("failed"), F.min("cents").alias("min_cents"),
        (F.sum("cents") / F.count("*")).alias("avg_cents"), F.max("cents").alias("max_cents"), F.sum("cents").alias("total_cents"),
        F.countDistinct("message").alias("error_types"), (F.countDistinct("document_id") * 3600.0 / F.sum("cents")).alias("throughput"),
        m.rate(done(), done() + failed()).alias("quality")).withColumn("stage", F.coalesce("stage", F.lit("all")))


@query("document_event_summary", sql("tasks", """select document_id, count(*) as events, sum(cents) as total_cents,
    count(*) filter (where status = 'failed') as errors,
    array_to_string(list_sort(list(distinct stage) filter (where status = 'completed')), ',') as stages_completed from tasks group by 1"""))
def document_event_summary(spark, d):
    stages = F.collect_set(F.when(F.col("status") == "completed", F.col("stage")))
    return b.tasks(spark, d).groupBy("document_id").agg(
        F.count("*").alias("events"), F.sum("cents").alias("total_cents"), failed().alias("errors"),
        F.when(done() > 0, F.array_join(F.array_sort(stages), ",")).alias("stages_completed"))


_CATEGORY = "case " + " ".join(
    "when " + " or ".join(f"contains(lower(message), '{w.lower()}')" for w in words) + f" then '{label}'" for label, words in rules.ERROR_PATTERNS.items()
) + " else 'permanent' end"
#: What to do where a category holds this share of all failures or more, in percent.
ADVICE = {"transient": (10, "retry later"), "resource": (10, "use smaller batches"), "rate_limit": (10, "slow down"), "data": (10, "check the input files")}


@query("failure_analysis", sql("tasks", f""", f as (select *, {_CATEGORY} as category from tasks where status = 'failed'),
    g as (select case when grouping(message) = 0 then 'message' when grouping(stage) = 0 then 'stage' when grouping(category) = 0 then 'category' else 'total' end as dimension,
    coalesce(message, stage, category) as value, count(*) as n, count(distinct document_id) as documents from f group by grouping sets ((message), (stage), (category), ())),
    r as (select *, row_number() over (partition by dimension order by n desc, value) as rank, (select count(*) from f) as total from g)
    select dimension, value, n, documents, rank, case """ + " ".join(
    f"when dimension = 'category' and value = '{c}' and n * 100 >= {share} * total then '{text}'" for c, (share, text) in ADVICE.items()) + " end as advice from r where rank <= 10"))
def failure_analysis(spark, d):
    """The ten most frequent messages, stages and categories, with advice."""
    rows = b.tasks(spark, d).where("status = 'failed'").withColumn("category", rules.error_category(F.col("message")))
    g = m.grouped_summary(rows, "message", "stage", "category", measures=[F.count("*").alias("n"), F.countDistinct("document_id").alias("documents")])
    rank = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("n"), "value"))  # over groups, not rows
    g = g.withColumn("rank", rank.cast("long")).where("rank <= 10").join(F.broadcast(rows.agg(F.count("*").alias("total"))))  # one row
    advice = [F.when((F.col("dimension") == "category") & (F.col("value") == c) & (F.col("n") * 100 >= share * F.col("total")), text) for c, (share, text) in ADVICE.items()]
    return g.withColumn("advice", F.coalesce(*advice)).select("dimension", "value", "n", "documents", "rank", "advice")


@query("recovery_results", sql("tasks", """, f as (select document_id, stage, min(ts) as failed_at from tasks where status = 'failed' group by 1, 2)
    select stage, count(*) as failed, count(*) filter (where ok) as recovered, count(*) filter (where ok) * 100.0 / count(*) as recovery_rate
    from (select f.stage, bool_or(t.ts > failed_at) as ok from f left join tasks t on t.document_id = f.document_id and t.stage = f.stage
          and t.status = 'completed' group by f.stage, f.document_id) group by 1"""))
def recovery_results(spark, d):
    t = b.tasks(spark, d)
    first = F.min(F.when(F.col("status") == "failed", F.col("ts")))
    last = F.max(F.when(F.col("status") == "completed", F.col("ts")))
    pairs = t.groupBy("document_id", "stage").agg(first.alias("failed_at"), last.alias("done_at")).where("failed_at is not null")
    ok = F.count_if(F.col("done_at") > F.col("failed_at"))
    return pairs.groupBy("stage").agg(F.count("*").alias("failed"), ok.alias("recovered"), m.rate(ok, F.count("*")).alias("recovery_rate"))


@query("confidence_distribution", sql("scored", """select cast(confidence // 10 * 10 as bigint) as bucket, count(*) as n,
    sum(confidence) / count(*) as average, median(confidence) as median, min(confidence) as low, max(confidence) as high,
    case when confidence // 10 * 10 < 70 then 'low' when confidence // 10 * 10 < 90 then 'medium' else 'high' end as level
    from scored where confidence > 0 group by 1, 7"""))
def confidence_distribution(spark, d):
    return m.confidence_distribution(b.scored(spark, d), "confidence")


@query("scanned_vs_text", sql("tasks", """, w as (select stage, case when k < 50 then 'scanned' else 'text' end as kind, sum(cents) * 1.0 / count(*) as av, count(*) as n,
    coalesce(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*) filter (where status in ('completed', 'failed')), 0), 0) as rate from tasks group by 1, 2)
    select s.stage, s.av as scanned_avg, t.av as text_avg, s.n as scanned, t.n as text, s.rate as scanned_rate, t.rate as text_rate, s.av - t.av as difference
    from w s join w t on s.stage = t.stage and s.kind = 'scanned' and t.kind = 'text'"""))
def scanned_vs_text(spark, d):
    kind = F.when(F.col("k") < 50, "scanned").otherwise("text")
    rows = b.tasks(spark, d).withColumn("kind", kind).groupBy("stage").pivot("kind", ["scanned", "text"])
    one = F.lit(1)
    good, bad = F.sum(F.when(F.col("status") == "completed", 1).otherwise(0)), F.sum(F.when(F.col("status") == "failed", 1).otherwise(0))
    wide = rows.agg((F.sum("cents") / F.count(one)).alias("avg"), F.count(one).alias("n"), m.rate(good, good + bad).alias("rate"))
    return wide.select(
        "stage", "scanned_avg", "text_avg", F.col("scanned_n").alias("scanned"), F.col("text_n").alias("text"), "scanned_rate", "text_rate",
        (F.col("scanned_avg") - F.col("text_avg")).alias("difference"))


@query("entity_statistics", sql("scored", """select entity_type, case when confidence > 80 then 'high' when confidence > 50 then 'medium' else 'low' end as band,
    count(*) as n, count(distinct entity_text) as texts from scored group by 1, 2"""))
def entity_statistics(spark, d):
    band = F.when(F.col("confidence") > 80, "high").when(F.col("confidence") > 50, "medium").otherwise("low")
    return b.scored(spark, d).groupBy("entity_type", band.alias("band")).agg(F.count("*").alias("n"), F.countDistinct("entity_text").alias("texts"))


@query("resolution_stats", sql("scored", """select entity_type, count(*) as total, count(*) filter (where confidence >= 70) as resolved,
    count(distinct case when confidence >= 70 then canonical_id end) as canonicals,
    count(*) filter (where confidence >= 70) * 100.0 / count(*) as resolved_rate from scored group by 1"""))
def resolution_stats(spark, d):
    ok = F.col("confidence") >= 70
    return b.scored(spark, d).groupBy("entity_type").agg(
        F.count("*").alias("total"), F.count_if(ok).alias("resolved"), F.countDistinct(F.when(ok, F.col("canonical_id"))).alias("canonicals"),
        m.rate(F.count_if(ok), F.count("*")).alias("resolved_rate"))


@query("document_entity_summary", sql("mentions", "select document_id, entity_type, count(*) as mentions, count(distinct entity_text) as texts from mentions group by 1, 2"))
def document_entity_summary(spark, d):
    return b.mentions(spark, d).groupBy("document_id", "entity_type").agg(F.count("*").alias("mentions"), F.countDistinct("entity_text").alias("texts"))


@query("ocr_job_health", sql("tasks", f""", o as (select *, (select as_of from ({LATE})) as as_of from tasks where stage = 'ocr'),
    h as (select count(*) filter (where status = 'completed') > 0.9 * count(*) filter (where status in ('completed', 'failed')) as healthy from o)
    select status, count(*) as jobs, sum(cents) * 1.0 / count(*) as avg_cents, count(*) filter (where ts > as_of - interval 1 hour) as last_hour,
    sum(cents) filter (where ts > as_of - interval 1 hour) * 1.0 / nullif(count(*) filter (where ts > as_of - interval 1 hour), 0) as avg_wait, healthy from o, h group by 1, healthy"""))
def ocr_job_health(spark, d):
    """By status, with the wait of the last hour's jobs (cents stand for seconds)
    and whether over nine tenths of the ended jobs were completed."""
    tasks = b.tasks(spark, d)
    rows, as_of = tasks.where("stage = 'ocr'"), tasks.agg(F.max("ts").alias("as_of"))
    healthy = rows.agg((done() > 0.9 * (done() + failed())).alias("healthy"))
    late = F.col("ts") > F.col("as_of") - F.expr("INTERVAL 1 HOUR")
    waits = F.when(late, F.col("cents"))
    found = rows.join(F.broadcast(as_of)).groupBy("status").agg(  # one row, as is healthy
        F.count("*").alias("jobs"), (F.sum("cents") / F.count("*")).alias("avg_cents"), F.count_if(late).alias("last_hour"),
        F.when(F.count(waits) > 0, F.sum(waits) / F.count(waits)).alias("avg_wait"))
    return found.join(F.broadcast(healthy))


@query("error_top_k", sql("tasks", f"""select stage, message, count(*) as n from tasks where status = 'failed' and ts > (select as_of from ({LATE})) - interval 1 hour
    group by 1, 2 order by n desc, stage, message limit 5"""))
def error_top_k(spark, d):
    return m.top_k(m.within_hours(b.tasks(spark, d), 1).where("status = 'failed'"), ["stage", "message"], 5)


@query("top_error_types", sql("tasks", "select message, count(*) as n from tasks where message is not null group by 1 order by n desc, message limit 10"))
def top_error_types(spark, d):
    return m.top_k(b.tasks(spark, d).where("message is not null"), ["message"], 10)


@query("dominant_types", sql("mentions", "select entity_type, count(*) as n from mentions group by 1 order by n desc, entity_type limit 5"))
def dominant_types(spark, d):
    return m.top_k(b.mentions(spark, d), ["entity_type"], 5)


@query("pipeline_throughput", sql("tasks", f""", r as (select stage, cents as p95_cents from (select stage, cents,
    row_number() over (partition by stage order by cents) - 1 as pos, count(*) over (partition by stage) as n from tasks where status = 'completed')
    where pos = least(cast(floor(n * 0.95) as bigint), n - 1)), l as ({LATE})
    select stage, any_value(p95_cents) as p95_cents, sum(cents) filter (where status = 'completed') * 1.0 / count(*) filter (where status = 'completed') as avg_cents,
    count(*) filter (where status = 'completed' and ts > as_of - interval 1 hour) as last_hour, count(*) filter (where status = 'completed' and ts > as_of - interval 24 hour) as last_day,
    count(*) filter (where status = 'failed') * 100.0 / count(*) as error_rate from tasks join r using (stage), l group by 1"""))
def pipeline_throughput(spark, d):
    tasks = b.tasks(spark, d)
    ranked = m.nearest_rank(tasks.where("status = 'completed'"), ["stage"], "cents", 0.95).withColumnRenamed("ranked_value", "p95_cents")
    late = lambda h: F.col("ts") > F.col("as_of") - F.expr(f"INTERVAL {h} HOURS")
    good = F.col("status") == "completed"
    found = tasks.join(F.broadcast(tasks.agg(F.max("ts").alias("as_of")))).groupBy("stage").agg(  # one row
        (F.sum(F.when(good, F.col("cents"))) / done()).alias("avg_cents"), F.count_if(good & late(1)).alias("last_hour"), F.count_if(good & late(24)).alias("last_day"),
        (failed() * 100.0 / F.count("*")).alias("error_rate"))
    return ranked.join(found, "stage")


@query("time_by_version", sql("tasks", """, v as (select k // 25 as version, sum(cents) as total, count(*) as runs from tasks group by 1)
    select version, runs, total / runs as avg_cents, (1 - (total / runs) / (first_value(total / runs) over (order by version))) * 100 as improvement from v"""))
def time_by_version(spark, d):
    v = b.tasks(spark, d).groupBy(F.floor(F.col("k") / 25).cast("long").alias("version")).agg(F.count("*").alias("runs"), (F.sum("cents") / F.count("*")).alias("avg_cents"))
    first = v.agg(F.min_by("avg_cents", "version").alias("base"))
    return v.join(F.broadcast(first)).withColumn("improvement", (1 - F.col("avg_cents") / F.col("base")) * 100).drop("base")


@query("cost_estimate", sql("files", """select host, count(*) as files, sum(size) as size, sum(pages) as pages, sum(pages) * 15 as ocr_units, sum(pages) * 4 as model_units
    from (select *, greatest(1, size // 1800) as pages from files) group by 1"""))
def cost_estimate(spark, d):
    pages = F.greatest(F.lit(1), F.floor(F.col("size") / 1800))
    return b.files(spark, d).withColumn("pages", pages).groupBy("host").agg(
        F.count("*").alias("files"), F.sum("size").alias("size"), F.sum("pages").alias("pages"),
        (F.sum("pages") * 15).alias("ocr_units"), (F.sum("pages") * 4).alias("model_units"))


@query("corpus_profile", """select case when grouping(lang) = 0 then 'lang' when grouping(source) = 0 then 'source' else 'total' end as dimension,
    coalesce(lang, source) as value, count(*) as documents, sum(n_chars) as chars, count(distinct text) as distinct_texts
    from documents group by grouping sets ((lang), (source), ())""")
def corpus_profile(spark, d):
    docs = table(spark, d, "documents").select("lang", "source", "n_chars", F.sha2("text", 256).alias("hash"))
    measures = [F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.countDistinct("hash").alias("distinct_texts")]
    return m.grouped_summary(docs, "lang", "source", measures=measures)


@query("session_status", sql("batches tasks", """select 'import' as kind, cast(project_id as varchar) as key, status as value, count(*) as n, sum(cents) as cents from batches group by 2, 3
    union all select 'service', cast(project_id as varchar), stage, count(*), sum(cents) from tasks group by 2, 3
    union all select 'error', cast(event_id as varchar), message, 1, cents from (select * from tasks where status = 'failed' order by ts desc, event_id desc limit 10)"""))
def session_status(spark, d):
    """Imports by status, cost by service (a stage), and the last ten errors."""
    tasks = b.tasks(spark, d)
    def part(df, kind, key, value):
        return df.groupBy(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.col(value).alias("value")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))

    errors = part(tasks.where("status = 'failed'").orderBy(F.desc("ts"), F.desc("event_id")).limit(10), "error", "event_id", "message")
    return part(b.batches(spark, d), "import", "project_id", "status").union(part(tasks, "service", "project_id", "stage")).union(errors)


@query("import_summary", sql("files", "select host, count(*) as files, min(size) as low, max(size) as high, sum(size) as total, sum(size) / count(*) as average from files group by 1"))
def import_summary(spark, d):
    return b.files(spark, d).groupBy("host").agg(
        F.count("*").alias("files"), F.min("size").alias("low"), F.max("size").alias("high"), F.sum("size").alias("total"), (F.sum("size") / F.count("*")).alias("average"))


@query("import_completeness", sql("items", """select batch_id, share, case when share >= 0.95 then 'PASS' when share >= 0.9 then 'WARN' else 'FAIL' end as verdict
    from (select batch_id, count(*) filter (where status = 'completed') * 1.0 / count(*) as share from items group by 1)"""))
def import_completeness(spark, d):
    share = b.items(spark, d).groupBy("batch_id").agg((done() / F.count("*")).alias("share"))
    return share.withColumn("verdict", F.when(F.col("share") >= 0.95, "PASS").when(F.col("share") >= 0.9, "WARN").otherwise("FAIL"))


@query("duplicate_files", """with h as (select sha256(text) as content_hash, doc_id from documents),
    g as (select content_hash, count(*) as copies, array_to_string(list_slice(list_sort(list(doc_id)), 1, 10), ',') as first_members from h group by 1 having count(*) > 1)
    select content_hash, copies, first_members, doc_id as member from h join g using (content_hash)""")
def duplicate_files(spark, d):
    """A row for each member of a group of equal contents, with the number of
    copies and the ten smallest members listed."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    groups = docs.groupBy("content_hash").agg(F.count("*").alias("copies")).where("copies > 1")
    listed = m.listed_first(docs.where("content_hash is not null"), ["content_hash"], "doc_id", 10, "first_members")
    return docs.join(groups.join(listed, "content_hash"), "content_hash").select("content_hash", "copies", "first_members", F.col("doc_id").alias("member"))


@query("import_error_patterns", sql("tasks", "select message, stage, count(*) as n from tasks where status = 'failed' group by 1, 2"))
def import_error_patterns(spark, d):
    return m.counts_by(b.tasks(spark, d).where("status = 'failed'"), "message", "stage")


@query("import_checks", sql("items", """select 'zero_size' as name, count(*) filter (where size_mb = 0) as n, count(*) filter (where size_mb = 0) = 0 as passed from items
    union all select 'completed', count(*) filter (where status = 'completed'), count(*) filter (where status = 'completed') >= 0.99 * count(*) from items"""))
def import_checks(spark, d):
    zero = F.count_if(F.col("size_mb") == 0)
    checks = F.array(F.struct(F.lit("zero_size").alias("name"), F.col("zero").alias("n"), (F.col("zero") == 0).alias("passed")),
                     F.struct(F.lit("completed").alias("name"), F.col("done").alias("n"), (F.col("done") >= 0.99 * F.col("all")).alias("passed")))
    return b.items(spark, d).agg(zero.alias("zero"), done().alias("done"), F.count("*").alias("all")).select(F.inline(checks))


@query("verification_rollup", sql("items", """, v as (select batch_id, count(*) filter (where status = 'completed') * 1.0 / count(*) as share from items group by 1)
    select ['PASS', 'WARN', 'FAIL'][worst + 1] as verdict, count(*) as projects from (select batch_id % 100 as project,
    max(case when share >= 0.95 then 0 when share >= 0.3 then 1 else 2 end) as worst from v group by 1) group by 1"""))
def verification_rollup(spark, d):
    share = b.items(spark, d).groupBy("batch_id").agg((done() / F.count("*")).alias("share"))
    level = F.when(F.col("share") >= 0.95, 0).when(F.col("share") >= 0.3, 1).otherwise(2)
    worst = share.groupBy((F.col("batch_id") % 100).alias("project")).agg(F.max(level).alias("worst"))
    verdict = F.element_at(F.array(*map(F.lit, ("PASS", "WARN", "FAIL"))), F.col("worst") + 1)
    return worst.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("projects"))


@query("queue_stats", sql("tasks", """, q as (select *, 'provider' || (k % 3) as provider from tasks)
    select case when grouping(project_id) = 0 then 'project' when grouping(provider) = 0 then 'provider' when grouping(stage) = 0 then 'stage' else 'total' end as dimension,
    coalesce(cast(project_id as varchar), provider, stage) as value, count(*) filter (where status = 'started') as started,
    count(*) filter (where status = 'completed') as completed, count(*) filter (where status = 'failed') as failed from q group by grouping sets ((project_id), (provider), (stage), ())"""))
def queue_stats(spark, d):
    """By project, provider (told from k) and stage; started is what is in processing."""
    rows = b.tasks(spark, d).withColumn("provider", F.concat(F.lit("provider"), F.col("k") % 3)).withColumnRenamed("project_id", "project")
    started = F.count_if(F.col("status") == "started")
    return m.grouped_summary(rows, "project", "provider", "stage", measures=[started.alias("started"), done().alias("completed"), failed().alias("failed")])


@query("cache_hit_rate", sql("tasks", """select date_trunc('hour', ts) as bucket, count(*) filter (where k < 60) as hits, count(*) filter (where k >= 60) as misses,
    count(*) filter (where k < 60) * 100.0 / count(*) as hit_rate from tasks group by 1"""))
def cache_hit_rate(spark, d):
    hit = F.count_if(F.col("k") < 60)
    rows = b.tasks(spark, d).groupBy(F.window("ts", "1 hour").alias("w")).agg(hit.alias("hits"), F.count_if(F.col("k") >= 60).alias("misses"), m.rate(hit, F.count("*")).alias("hit_rate"))
    return rows.select(F.col("w.start").alias("bucket"), "hits", "misses", "hit_rate")


@query("reprocess_reuse_rate", sql("tasks", """, r as (select document_id, stage, row_number() over (partition by document_id, stage order by ts, event_id) as version, status from tasks)
    select a.stage, count(*) as reprocessed, count(*) filter (where p.status = 'completed') as reused from r a
    left join r p on p.document_id = a.document_id and p.stage = a.stage and p.version = a.version - 1 where a.version > 1 group by 1"""))
def reprocess_reuse_rate(spark, d):
    order = Window.partitionBy("document_id", "stage").orderBy("ts", "event_id")
    rows = b.tasks(spark, d).withColumn("before", F.lag("status").over(order)).where("before is not null")
    return rows.groupBy("stage").agg(F.count("*").alias("reprocessed"), F.count_if(F.col("before") == "completed").alias("reused"))


@query("aggregate_structures", sql("scored", """select document_id, entity_type, array_to_string(list_sort(list(distinct entity_text)), ',') as entities,
    max_by(entity_text, chunk_index * 100000 + ordinal) as last_seen, min_by(entity_text, chunk_index * 100000 + ordinal) as first_seen from scored group by 1, 2"""))
def aggregate_structures(spark, d):
    at = F.struct("chunk_index", "ordinal")
    return b.scored(spark, d).groupBy("document_id", "entity_type").agg(
        F.array_join(F.array_sort(F.collect_set("entity_text")), ",").alias("entities"), F.max_by("entity_text", at).alias("last_seen"), F.min_by("entity_text", at).alias("first_seen"))
