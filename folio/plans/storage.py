"""Source, sink and table-edit queries, and their SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table
from folio.sources import storage as s

EVENT = "event_id bigint, document_id bigint, stage string, status string"


EXTENSIONS = ["pdf", "png", "jpeg", "tiff", "txt", "doc", "docx", "zip"]
_MIMES = " ".join(f"when '{k}' then '{v}'" for k, v in s.MIME.items())


@query("scan_corpus", f"""with f as (select page_id // 20 as n, {EXTENSIONS}[page_id // 20 % 8 + 1] as extension, string_agg(replace(html, chr(10), ' ') || chr(10), '' order by page_id) as content from pages group by 1, 2)
    select n || '.' || extension as name, strlen(content) as size, round(strlen(content) / 1048576.0, 2) as size_mb, sha256(content) as content_hash, case extension {_MIMES} end as mime, true as recent from f where extension <> 'zip'""")
def scan_corpus(spark, d):
    """Files of twenty pages each, of all types that are taken in and one that isn't, catalogued by what was written."""
    path, number = s.shared_path(spark, "corpus"), F.floor(F.col("page_id") / 20)
    name = F.concat_ws(".", number.cast("string"), F.element_at(F.array(*map(F.lit, EXTENSIONS)), (number % 8 + 1).cast("int")))
    began = datetime.datetime.now(datetime.timezone.utc) - datetime.timedelta(minutes=5)
    s.write_files(table(spark, d, "pages").select(name.alias("file"), F.col("page_id").alias("place"), F.regexp_replace("html", "\n", " ").alias("value")), path)
    return s.scan_corpus(spark, path).withColumn("recent", F.col("modified") > F.lit(began)).drop("modified")


@query("scan_manifest_json", sql("items", "select batch_id, item, document_id, size_mb from items"))
def scan_manifest_json(spark, d):
    path = s.shared_path(spark, "manifest")
    rows = b.items(spark, d).groupBy("batch_id").agg(F.collect_list(F.struct("item", "document_id", "size_mb")).alias("files"))
    rows.withColumn("project_id", F.col("batch_id") % 10).write.json(path)
    return s.read_manifest(spark, path, "item int, document_id bigint, size_mb bigint").drop("project_id")


@query("scan_event_log", sql("tasks", "select event_id, document_id, stage, status from tasks where event_id % 10 <> 0"))
def scan_event_log(spark, d):
    path = s.shared_path(spark, "events")
    line = F.to_json(F.struct("event_id", "document_id", "stage", "status"))
    b.tasks(spark, d).select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken"), line)).otherwise(line).alias("value")).write.text(path)
    return s.read_event_log(spark, path, EVENT)


@query("scan_document_events", sql("tasks", "select event_id, stage, cast(ts as date) as day from tasks where document_id = 7 and cast(ts as date) > (select max(cast(ts as date)) from tasks) - 7"))
def scan_document_events(spark, d):
    path = s.shared_path(spark, "daily")
    tasks = b.tasks(spark, d).withColumn("day", F.to_date("ts"))
    tasks.select("event_id", "document_id", "stage", "day").write.partitionBy("day").parquet(path)
    last = tasks.agg(F.max("day")).first()[0]
    rows = spark.read.parquet(path)
    if last is None:
        return rows.select("event_id", "stage", "day")
    return rows.where((F.col("day") > F.date_sub(F.lit(last), 7)) & (F.col("document_id") == 7)).select("event_id", "stage", "day")


@query("table_select", sql("tasks", "select event_id, ts, cents from tasks where stage = 'ocr' and status = 'failed' order by ts desc, event_id limit 50"))
def table_select(spark, d):
    return b.tasks(spark, d).where("stage = 'ocr' and status = 'failed'").orderBy(F.desc("ts"), "event_id").limit(50).select("event_id", "ts", "cents")


@query("column_rename_map", sql("batches", """select batch_id as import_id, case status when 'completed' then 'done' when 'pending' then 'queued' else 'running' end as state,
    '{"priority":"' || priority || '","project_id":' || project_id || '}' as metadata from batches"""))
def column_rename_map(spark, d):
    state = F.when(F.col("status") == "completed", "done").when(F.col("status") == "pending", "queued").otherwise("running")
    rows = b.batches(spark, d).withColumnsRenamed({"batch_id": "import_id"})
    return rows.select("import_id", state.alias("state"), F.to_json(F.struct("priority", "project_id")).alias("metadata"))


@query("table_append", sql("batches", "select priority, count(*) * 2 as n from batches group by 1"))
def table_append(spark, d):
    path = s.shared_path(spark, "append")
    rows = b.batches(spark, d).select("batch_id", "priority")
    for _ in range(2):
        rows.write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("priority").agg(F.count("*").alias("n"))


@query("table_update", sql("batches", "select batch_id, case when project_id % 3 = 0 then 'cancelled' else status end as status from batches"))
def table_update(spark, d):
    batches = b.batches(spark, d).select("batch_id", "project_id", "status")
    changes = batches.where("project_id % 3 = 0").select("batch_id", F.lit("cancelled").alias("status"))
    return s.update_rows(batches, changes, "batch_id").select("batch_id", "status")


@query("table_delete", sql("batches", "select batch_id from batches where status <> 'pending'"))
def table_delete(spark, d):
    batches = b.batches(spark, d)
    return s.delete_rows(batches, batches.where("status = 'pending'"), ["batch_id"]).select("batch_id")


@query("insert_ignore", "select doc_id, quality from (select doc_id, max(quality) as quality from labels group by 1) union all select doc_id, -1 from documents where doc_id not in (select doc_id from labels)")
def insert_ignore(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return s.insert_ignore(labels, table(spark, d, "documents").select("doc_id", F.lit(-1).alias("quality")), ["doc_id"])


@query("upsert_chunk", sql("chunks", "select document_id, chunk_index, case when document_id % 4 = 0 then -1 else length(chunk_text) end as size from chunks"))
def upsert_chunk(spark, d):
    old = b.chunks(spark, d).select("document_id", "chunk_index", F.length("chunk_text").alias("size"))
    return s.upsert(old, old.where("document_id % 4 = 0").withColumn("size", F.lit(-1)), ["document_id", "chunk_index"])


@query("cascade_delete", sql("mentions", """select 'chunks' as name, count(*) as n from chunks where source <> 'src0' union all select 'mentions', count(*) from mentions where source <> 'src0'
    union all select 'relationships', count(*) - count(distinct document_id) from chunks where source <> 'src0'"""))
def cascade_delete(spark, d):
    """What is left of three tables once a source's documents are gone: relationships go first, then mentions and chunks."""
    gone = table(spark, d, "documents").where("source = 'src0'").select(F.col("doc_id").alias("document_id"))
    chunks = b.chunks(spark, d)
    follows = Window.partitionBy("document_id").orderBy("chunk_index")
    relationships = chunks.select("document_id", F.col("chunk_index").alias("source_chunk"), F.lead("chunk_index").over(follows).alias("target_chunk")).where("target_chunk is not null")
    left = s.cascade(gone, {"relationships": relationships, "mentions": b.mentions(spark, d), "chunks": chunks}, "document_id")
    parts = [rows.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, rows in left.items()]
    return parts[0].union(parts[1]).union(parts[2])


_TRAIL = "document_id bigint, timestamp_us bigint, event_type string, stage string, status string, message string, elapsed_seconds double, worker_id string"


@query("export_audit_trail", sql("tasks", """, s as (select document_id, array_to_string(list_sort(list(distinct stage) filter (where status = 'completed')), ',') as stages_completed, sum(cents) / 100.0 as total_seconds,
        count(*) filter (where status = 'failed') as error_count, count(*) as event_count from tasks group by 1)
    select document_id, epoch_us(ts) as timestamp_us, case status when 'failed' then 'error' else 'processing' end as event_type, stage, status, message, cents / 100.0 as elapsed_seconds, 'worker' || event_id % 4 as worker_id,
    coalesce(stages_completed, '') as stages_completed, total_seconds, error_count, event_count from tasks join s using (document_id)"""))
def export_audit_trail(spark, d):
    """Each document's events with seven fields as CSV, their summary as JSON; both read back."""
    events, summary = s.shared_path(spark, "audit"), s.shared_path(spark, "audit-summary")
    bad = F.col("status") == "failed"
    trail = b.tasks(spark, d).select(
        "document_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp_us"), F.when(bad, "error").otherwise("processing").alias("event_type"), "stage", "status", "message",
        (F.col("cents") / 100.0).alias("elapsed_seconds"), F.concat(F.lit("worker"), F.col("event_id") % 4).alias("worker_id"), "cents")
    trail.drop("cents").write.option("header", "true").csv(events)
    told = trail.groupBy("document_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("status") == "completed", F.col("stage")))).alias("stages_completed"), (F.sum("cents") / 100.0).alias("total_seconds"),
        F.count_if(bad).alias("error_count"), F.count("*").alias("event_count"))
    told.write.json(summary)
    back = spark.read.schema("document_id bigint, stages_completed array<string>, total_seconds double, error_count bigint, event_count bigint").json(summary)
    rows = spark.read.schema(_TRAIL).option("header", "true").csv(events)
    return rows.join(back.withColumn("stages_completed", F.array_join("stages_completed", ",")), "document_id")


@query("export_entities", sql("scored", "select canonical_id, count(*) as mentions from scored group by 1"))
def export_entities(spark, d):
    path = s.shared_path(spark, "entities")
    b.scored(spark, d).groupBy("canonical_id").agg(F.count("*").alias("mentions")).write.json(path)
    return spark.read.schema("canonical_id string, mentions bigint").json(path)


def _daily(spark, d, name):
    """The tasks as a table by day; its path and the latest time in it."""
    path = s.shared_path(spark, name)
    tasks = b.tasks(spark, d).select("event_id", "document_id", "stage", "ts", F.to_date("ts").alias("day"))
    tasks.write.partitionBy("day").parquet(path)
    return path, tasks.agg(F.max("ts")).first()[0]


_BY_DAY = "event_id bigint, document_id bigint, stage string, ts timestamp_ntz, day date"


@query("retention_filter", sql("tasks", """select case when cast(ts as date) > (select max(cast(ts as date)) from tasks) - 14 then 'kept' else 'archived' end as state,
    cast(ts as date) as day, count(*) as n, sum(event_id) as event_sum from tasks group by 1, 2"""))
def retention_filter(spark, d):
    """Days older than a fortnight go to the archive and leave the table; both are read back."""
    path, last = _daily(spark, d, "retention")
    archive = s.shared_path(spark, "archive")
    if last is not None:
        s.retire(spark, path, archive, "day", (last.date() - datetime.timedelta(days=13)).isoformat())
    out = None
    for state, at in (("kept", path), ("archived", archive)):
        rows = spark.read.schema(_BY_DAY).parquet(at) if s.exists(spark, at) else spark.createDataFrame([], _BY_DAY)
        part = rows.groupBy(F.lit(state).alias("state"), "day").agg(F.count("*").alias("n"), F.sum("event_id").alias("event_sum"))
        out = part if out is None else out.unionByName(part)
    return out


@query("history_prune", sql("tasks", """, l as (select max(ts) - interval 10 day as bar from tasks) select count(*) as total, count(*) filter (where ts < bar) as prunable,
    count(*) filter (where ts >= bar) as remaining, min(ts) filter (where ts >= bar) as oldest, sum(event_id) filter (where ts >= bar) as event_sum from tasks, l"""))
def history_prune(spark, d):
    """What a dry run would delete, and what is there after the real one."""
    path, last = _daily(spark, d, "history")
    total = spark.read.schema(_BY_DAY).parquet(path).count()
    bar, prunable = None, 0
    if last is not None:
        bar = last - datetime.timedelta(days=10)
        prunable = s.prune(spark, path, "day", "ts", bar, dry_run=True)
        s.prune(spark, path, "day", "ts", bar)
    left = spark.read.schema(_BY_DAY).parquet(path)
    return left.agg(F.lit(total).cast("long").alias("total"), F.lit(prunable).cast("long").alias("prunable"), F.count("*").alias("remaining"), F.min("ts").alias("oldest"), F.sum("event_id").alias("event_sum"))


@query("file_inventory_stats", sql("files", "select split_part(host, '.', -1) as kind, count(*) as files, sum(size) as size, min(file_id) as first_id, max(file_id) as last_id from files group by 1"))
def file_inventory_stats(spark, d):
    kind = F.element_at(F.split("host", r"\."), -1)
    return b.files(spark, d).groupBy(kind.alias("kind")).agg(F.count("*").alias("files"), F.sum("size").alias("size"), F.min("file_id").alias("first_id"), F.max("file_id").alias("last_id"))
