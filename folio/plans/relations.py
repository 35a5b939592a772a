"""Joins, window, set and top-k queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import chunking as c
from folio.operators import metrics as m
from folio.operators import windows as w
from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table
from folio.sources.storage import shared_path

LAST = ", last as (select * from (select *, row_number() over (partition by document_id order by ts desc, event_id desc) as rn from tasks) where rn = 1)"


def _canonicals(spark, d):
    rows = b.scored(spark, d).groupBy("canonical_id").agg(F.count("*").alias("mentions"), F.min("entity_text").alias("canonical_name"))
    return rows.where("mentions >= 2")


CANON = ", canon as (select canonical_id, count(*) as mentions, min(entity_text) as canonical_name from scored group by 1 having count(*) >= 2)"


@query("mentions_with_canonical", sql("scored", CANON + """ select document_id, chunk_index, entity_type, ordinal, canonical_name
    from scored left join canon using (canonical_id)"""))
def mentions_with_canonical(spark, d):
    return b.scored(spark, d).join(_canonicals(spark, d), "canonical_id", "left").select("document_id", "chunk_index", "entity_type", "ordinal", "canonical_name")


@query("resolution_pairs", sql("scored", CANON + " select document_id, canonical_name, count(*) as n from scored join canon using (canonical_id) group by 1, 2"))
def resolution_pairs(spark, d):
    rows = b.scored(spark, d).join(_canonicals(spark, d), "canonical_id")
    return m.counts_by(rows, "document_id", "canonical_name")


@query("latest_task_join", sql("tasks", LAST + """ select o_custkey, count(*) as orders, any_value(stage) as stage, any_value(status) as status
    from orders left join last on document_id = o_custkey group by 1"""))
def latest_task_join(spark, d):
    last = w.latest_by(b.tasks(spark, d), ["document_id"], ["ts", "event_id"]).select(F.col("document_id").alias("o_custkey"), "stage", "status")
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return orders.join(last, "o_custkey", "left")


@query("pipeline_status_view", sql("tasks", LAST + """ select document_id, stage, status, ts, n_name as project from last join nation on n_nationkey = project_id"""))
def pipeline_status_view(spark, d):
    last = w.latest_by(b.tasks(spark, d), ["document_id"], ["ts", "event_id"])
    projects = table(spark, d, "nation").select(F.col("n_nationkey").alias("project_id"), F.col("n_name").alias("project"))
    return last.join(projects, "project_id").select("document_id", "stage", "status", "ts", "project")


@query("latest_per_document", sql("tasks", LAST + " select document_id, event_id, stage, status, ts from last"))
def latest_per_document(spark, d):
    return w.latest_by(b.tasks(spark, d), ["document_id"], ["ts", "event_id"]).select("document_id", "event_id", "stage", "status", "ts")


@query("relationships_of_document", """select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders
    where o_custkey in (select c_custkey from customer where c_nationkey = 3)) and l_partkey in (select p_partkey from part where p_size < 10)""")
def relationships_of_document(spark, d):
    customers = table(spark, d, "customer").where("c_nationkey = 3")
    orders = table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    small = table(spark, d, "part").where("p_size < 10")
    items = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return items.join(small, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query("documents_without_chunks", "select o_orderkey, o_orderdate from orders where o_orderkey not in (select l_orderkey from lineitem) and o_orderdate < timestamp '2000-01-01'")
def documents_without_chunks(spark, d):
    orders = table(spark, d, "orders").where("o_orderdate < timestamp '2000-01-01'")
    return orders.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_orderdate")


@query("stuck_ocr_jobs", sql("tasks", """select a.event_id, p.event_id as pending_id from tasks a join tasks p on a.document_id = p.document_id and a.stage = 'ocr' and p.stage = 'ocr'
    and a.status = 'completed' and p.status = 'started' and p.ts < a.ts - interval 30 minute and p.ts > a.ts - interval 12 hour"""))
def stuck_ocr_jobs(spark, d):
    ocr = b.tasks(spark, d).where("stage = 'ocr'")
    done = ocr.where("status = 'completed'").select("document_id", "event_id", "ts")
    pending = ocr.where("status = 'started'").select("document_id", F.col("event_id").alias("pending_id"), F.col("ts").alias("since"))
    late = (F.col("since") < F.col("ts") - F.expr("INTERVAL 30 MINUTES")) & (F.col("since") > F.col("ts") - F.expr("INTERVAL 12 HOURS"))
    return done.join(pending, "document_id").where(late).select("event_id", "pending_id")


@query("pending_ocr_jobs", sql("tasks", """select event_id, document_id, ts from tasks
    where stage = 'ocr' and (status = 'started' or message is null) order by ts desc, event_id limit 10"""))
def pending_ocr_jobs(spark, d):
    rows = b.tasks(spark, d).where("stage = 'ocr' and (status = 'started' or message is null)")
    return rows.orderBy(F.desc("ts"), "event_id").limit(10).select("event_id", "document_id", "ts")


@query("mentions_of_document", sql("mentions", """select d.doc_id, c.chunk_index, m.entity_type, m.entity_text from documents d join chunks c on c.document_id = d.doc_id
    join mentions m on m.document_id = c.document_id and m.chunk_index = c.chunk_index"""))
def mentions_of_document(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("document_id"))
    keys = b.chunks(spark, d).select("document_id", "chunk_index").join(docs, "document_id")
    rows = keys.join(b.mentions(spark, d).select("document_id", "chunk_index", "entity_type", "entity_text"), ["document_id", "chunk_index"])
    return rows.withColumnRenamed("document_id", "doc_id")


@query("recent_document_board", sql("batches tasks", """, recent as (select * from batches order by created_at desc, batch_id limit 50), f as (
    select document_id, count(*) as errors, max(message) as error from tasks where status = 'failed' group by 1)
    select batch_id, coalesce(error, 'none') as error, coalesce(errors, 0) as errors from recent left join f on document_id = project_id"""))
def recent_document_board(spark, d):
    recent = b.batches(spark, d).orderBy(F.desc("created_at"), "batch_id").limit(50)
    failed = b.tasks(spark, d).where("status = 'failed'").groupBy(F.col("document_id").alias("project_id")).agg(F.count("*").alias("errors"), F.max("message").alias("error"))
    rows = recent.join(failed, "project_id", "left")
    return rows.select("batch_id", F.coalesce("error", F.lit("none")).alias("error"), F.coalesce("errors", F.lit(0)).alias("errors"))


@query("missing_in_target", "select count(*) as missing, count(*) = 0 as passed from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def missing_in_target(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left_anti")
    return rows.agg(F.count("*").alias("missing"), (F.count("*") == 0).alias("passed"))


@query("processing_stage_of", sql("mentions", """, m as (select document_id, count(*) as n from mentions group by 1), l as (select distinct doc_id from labels)
    select d.doc_id, case when length(text) = 0 then 'ocr' when n_chars < 200 then 'chunking' when m.n is null then 'entity_extraction'
    when l.doc_id is null then 'relationship_building' else 'done' end as stage from documents d left join m on m.document_id = d.doc_id left join l on l.doc_id = d.doc_id"""))
def processing_stage_of(spark, d):
    found = b.mentions(spark, d).groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n"))
    labels = table(spark, d, "labels").select("doc_id").distinct().withColumn("done", F.lit(True))
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("size"), "n_chars")
    stage = (F.when(F.col("size") == 0, "ocr").when(F.col("n_chars") < 200, "chunking").when(F.col("n").isNull(), "entity_extraction")
             .when(F.col("done").isNull(), "relationship_building").otherwise("done"))
    return docs.join(found, "doc_id", "left").join(labels, "doc_id", "left").select("doc_id", stage.alias("stage"))


@query("entity_pair_theta", sql("scored", """, e as (select distinct document_id, canonical_id from scored)
    select a.document_id, a.canonical_id as source_id, z.canonical_id as target_id from e a join e z on a.document_id = z.document_id and a.canonical_id < z.canonical_id"""))
def entity_pair_theta(spark, d):
    from folio.operators.graph import cooccurrence

    return cooccurrence(b.scored(spark, d)).select("document_id", "source_id", "target_id")


@query("duplicate_entity_pairs", sql("scored", """, n as (select distinct entity_type, canonical_id, lower(entity_text) as name from scored), e as (select distinct document_id, canonical_id from scored),
    f as (select canonical_id, min(document_id) as first from e group by 1)
    select a.canonical_id as source_id, z.canonical_id as target_id, null as document_id, 95 as similarity from n a join n z on a.entity_type = z.entity_type
    and a.canonical_id <> z.canonical_id and contains(z.name, a.name) union all select canonical_id, canonical_id, document_id, 100 from e join f using (canonical_id) where document_id > first"""))
def duplicate_entity_pairs(spark, d):
    """Names of one type that contain each other (95), and the documents that
    repeat an earlier document's name (100): a row each, not all their pairs."""
    from folio.operators.resolve import contained_names

    scored = b.scored(spark, d)
    names = scored.select("entity_type", "canonical_id", F.lower("entity_text").alias("name")).distinct()
    inner = contained_names(names, 3).select("source_id", "target_id", F.lit(None).cast("long").alias("document_id"), "similarity")
    seen = scored.select("document_id", "canonical_id").distinct()
    first = seen.groupBy("canonical_id").agg(F.min("document_id").alias("first"))
    same = seen.join(first, "canonical_id").where("document_id > first")
    return inner.union(same.select("canonical_id", "canonical_id", "document_id", F.lit(100)))


@query("project_dim_join", "select n_name, count(*) as customers, sum(cast(round(c_acctbal * 100) as bigint)) as cents from nation left join customer on c_nationkey = n_nationkey group by 1")
def project_dim_join(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.groupBy("n_name").agg(F.count("*").alias("customers"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"))


@query("status_lookup_join", sql("items tasks", LAST + """ select i.batch_id, item, coalesce(l.status, 'pending') as status, coalesce(l.stage, 'unknown') as stage
    from items i left join last l using (document_id)"""))
def status_lookup_join(spark, d):
    last = w.latest_by(b.tasks(spark, d), ["document_id"], ["ts", "event_id"]).select("document_id", F.col("status").alias("now"), "stage")
    rows = b.items(spark, d).join(last, "document_id", "left")
    return rows.select("batch_id", "item", F.coalesce("now", F.lit("pending")).alias("status"), F.coalesce("stage", F.lit("unknown")).alias("stage"))


@query("chunk_neighbours", sql("turns", """select document_id, chunk_index, lag(chunk_index) over (partition by document_id order by chunk_index) as previous_chunk,
    lead(chunk_index) over (partition by document_id order by chunk_index) as next_chunk from turns"""))
def chunk_neighbours(spark, d):
    return c.chunk_neighbours(b.turns(spark, d).select("document_id", "chunk_index"))


@query("chunk_overlap_flags", sql("chunks", """select document_id, chunk_index, coalesce(lead(char_start) over (partition by document_id order by chunk_index) < char_end, false) as overlaps from chunks"""))
def chunk_overlap_flags(spark, d):
    from pyspark.sql import Window

    nxt = F.lead("char_start").over(Window.partitionBy("document_id").orderBy("chunk_index"))
    return b.chunks(spark, d).select("document_id", "chunk_index", F.coalesce(nxt < F.col("char_end"), F.lit(False)).alias("overlaps"))


@query("stage_gap_timing", sql("tasks", """select document_id, event_id, stage, lag(stage) over o as previous_stage, epoch_us(ts) - epoch_us(lag(ts) over o) as gap_us
    from tasks where status = 'completed' window o as (partition by document_id order by ts, event_id)"""))
def stage_gap_timing(spark, d):
    return w.stage_gaps(b.tasks(spark, d))


@query("position_context", sql("chunks", """, p as (select document_id, chunk_index, row_number() over (partition by document_id order by chunk_index) - 1 as pos,
    count(*) over (partition by document_id) as n from chunks) select document_id, chunk_index, case when pos = 0 then 'beginning' when pos = n - 1 then 'end'
    when pos * 1.0 / n < 0.2 then 'early' when pos * 1.0 / n > 0.8 then 'late' else 'middle' end as position from p"""))
def position_context(spark, d):
    return w.position_context(b.chunks(spark, d))


@query("running_batch_size", sql("items", "select batch_id, item, document_id, size_mb, sum(size_mb) over (partition by batch_id order by item, document_id, cents rows unbounded preceding) as running from items"))
def running_batch_size(spark, d):
    rows = w.running_total(b.items(spark, d), ["batch_id"], ["item", "document_id", "cents"], "size_mb")
    return rows.select("batch_id", "item", "document_id", "size_mb", "running")


@query("first_seen_chunk", sql("scored", "select document_id, canonical_id, min(chunk_index) as first_chunk from scored group by 1, 2"))
def first_seen_chunk(spark, d):
    return b.scored(spark, d).groupBy("document_id", "canonical_id").agg(F.min("chunk_index").alias("first_chunk"))


@query("top_k_per_group", sql("scored", """select source, canonical_id, n, rank from (select source, canonical_id, count(*) as n,
    row_number() over (partition by source order by count(*) desc, canonical_id) as rank from scored group by 1, 2) where rank <= 5"""))
def top_k_per_group(spark, d):
    n = m.counts_by(b.scored(spark, d), "source", "canonical_id")
    return w.top_k_per_group(n, ["source"], [F.desc("n"), F.col("canonical_id")], 5)


@query("prev_period_trend", sql("tasks", """, w as (select max(ts) as as_of from tasks), n as (select count(*) filter (where ts > as_of - interval 24 hour) as now,
    count(*) filter (where ts <= as_of - interval 24 hour and ts > as_of - interval 48 hour) as before from tasks, w where status = 'failed')
    select now, before, case when now > before * 1.1 then 'increasing' when now < before * 0.9 then 'decreasing' else 'stable' end as trend from n"""))
def prev_period_trend(spark, d):
    tasks = b.tasks(spark, d)
    two_days = m.within_hours(tasks, 48).where("status = 'failed'")
    as_of = F.broadcast(tasks.agg(F.max("ts").alias("as_of")))  # one row
    recent = F.col("ts") > F.col("as_of") - F.expr("INTERVAL 24 HOURS")
    n = two_days.join(as_of, F.col("ts") <= F.col("as_of")).agg(F.count_if(recent).alias("now"), F.count_if(~recent).alias("before"))
    trend = F.when(F.col("now") > F.col("before") * 1.1, "increasing").when(F.col("now") < F.col("before") * 0.9, "decreasing").otherwise("stable")
    return n.withColumn("trend", trend)


@query("priority_sort", sql("batches", "select batch_id, priority, cents from batches order by priority, cents, batch_id limit 100"))
def priority_sort(spark, d):
    return b.batches(spark, d).orderBy("priority", "cents", "batch_id").limit(100).select("batch_id", "priority", "cents")


@query("recent_documents", sql("batches", "select batch_id, created_at from batches order by created_at desc, batch_id limit 25"))
def recent_documents(spark, d):
    return b.batches(spark, d).orderBy(F.desc("created_at"), "batch_id").limit(25).select("batch_id", "created_at")


@query("dedup_by_hash", "select md5(text) as digest, min(doc_id) as doc_id from documents group by 1")
def dedup_by_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("digest")).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))


@query("distinct_preserving_order", sql("turns", """select document_id, array_to_string(list_slice(list(role order by first_at), 1, 20), ',') as roles
    from (select document_id, role, min(chunk_index) as first_at from turns group by 1, 2) group by 1"""))
def distinct_preserving_order(spark, d):
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "role"))), lambda x: x["role"])
    return b.turns(spark, d).groupBy("document_id").agg(F.array_join(F.slice(F.array_distinct(ordered), 1, 20), ",").alias("roles"))


@query("set_union_aliases", sql("scored", """select canonical_id, array_to_string(list_sort(list(distinct entity_text)), ',') as aliases from scored group by 1"""))
def set_union_aliases(spark, d):
    per_doc = b.scored(spark, d).groupBy("canonical_id", "document_id").agg(F.collect_set("entity_text").alias("names"))
    return per_doc.groupBy("canonical_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))), ",").alias("aliases"))


@query("subset_check", "select 'labels in documents' as name, count(*) as outside from (select doc_id from labels except select doc_id from documents) union all select 'documents in labels', count(*) from (select doc_id from documents except select doc_id from labels)")
def subset_check(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    one = labels.subtract(docs).agg(F.lit("labels in documents").alias("name"), F.count("*").alias("outside"))
    return one.union(docs.subtract(labels).agg(F.lit("documents in labels").alias("name"), F.count("*").alias("outside")))


@query("overlap_resolution", sql("chunks", """, s as (select document_id, k.chunk_index, k.char_start, k.char_end, length(k.chunk_text) as score from chunks k),
    f as (select *, case when char_start >= coalesce(max(char_end) over (partition by document_id order by char_start, char_end desc rows between unbounded preceding and 1 preceding), char_start)
      then 1 else 0 end as fresh from s), i as (select *, sum(fresh) over (partition by document_id order by char_start, char_end desc rows unbounded preceding) as island from f)
    select document_id, island, chunk_index from (select *, row_number() over (partition by document_id, island order by score desc, chunk_index) as rn from i) where rn = 1"""))
def overlap_resolution(spark, d):
    rows = w.islands(b.chunks(spark, d).withColumn("score", F.length("chunk_text")), ["document_id"], "char_start", "char_end")
    best = w.top_k_per_group(rows, ["document_id", "island"], [F.desc("score"), F.col("chunk_index")], 1)
    return best.select("document_id", "island", "chunk_index")


@query("sliding_rate_count", sql("tasks", """select event_id, document_id, count(*) over (partition by document_id order by epoch_us(ts) range between 43200000000 preceding and current row) as recent from tasks"""))
def sliding_rate_count(spark, d):
    return w.trailing_count(b.tasks(spark, d), "document_id", 12 * 3600).select("event_id", "document_id", "recent")


@query("batch_by_size", sql("items", """select document_id, batch_id, item, size_mb, cast((row_number() over (partition by batch_id % 50 order by size_mb, batch_id, item, document_id, cents) - 1) // 20 as bigint) as batch from items"""))
def batch_by_size(spark, d):
    rows = b.items(spark, d).withColumn("project", F.col("batch_id") % 50)
    rows = w.fixed_batches(rows, ["project"], [F.col(x) for x in ("size_mb", "batch_id", "item", "document_id", "cents")], 20)
    return rows.select("document_id", "batch_id", "item", "size_mb", "batch")


@query("batch_fixed", "select doc_id, source, cast((row_number() over (partition by source order by doc_id) - 1) // 25 as bigint) as batch from documents")
def batch_fixed(spark, d):
    return w.fixed_batches(table(spark, d, "documents").select("doc_id", "source"), ["source"], [F.col("doc_id")], 25)


@query("batch_summary", sql("items", """, s as (select batch_id, count(*) as files, sum(size_mb) as size_mb, sum(greatest(5, size_mb) * case when size_mb < 10 then 1 when size_mb < 30 then 3 else 8 end) as work from items group by 1)
    select batch_id, files, size_mb, case when files < 3 then 'small' when files < 6 then 'medium' else 'large' end as batch_type, greatest(5, work // 5) as minutes from s"""))
def batch_summary(spark, d):
    size = F.col("size_mb")
    work = F.greatest(F.lit(5), size) * F.when(size < 10, 1).when(size < 30, 3).otherwise(8)
    s = b.items(spark, d).groupBy("batch_id").agg(F.count("*").alias("files"), F.sum("size_mb").alias("size_mb"), F.sum(work).alias("work"))
    kind = F.when(F.col("files") < 3, "small").when(F.col("files") < 6, "medium").otherwise("large")
    return s.select("batch_id", "files", "size_mb", kind.alias("batch_type"), F.greatest(F.lit(5), F.floor(F.col("work") / 5)).cast("long").alias("minutes"))


@query("recovery_plan", sql("items", """, s as (select batch_id, count(*) as files, count(*) filter (where status = 'failed') as failed, max(document_id) % 5 as retries from items group by 1)
    select batch_id, failed, retries, case when failed * 2 > files then 'delayed' when retries >= 3 then 'manual' else 'immediate' end as plan,
    5 * failed + case when failed * 2 > files then 10 else 0 end as minutes from s where failed > 0"""))
def recovery_plan(spark, d):
    """How to go on with each batch that has failures; retries are told from the documents."""
    s = b.items(spark, d).groupBy("batch_id").agg(
        F.count("*").alias("files"), F.count_if(F.col("status") == "failed").alias("failed"), (F.max("document_id") % 5).alias("retries")).where("failed > 0")
    many = F.col("failed") * 2 > F.col("files")
    plan = F.when(many, "delayed").when(F.col("retries") >= 3, "manual").otherwise("immediate")
    return s.select("batch_id", "failed", "retries", plan.alias("plan"), (5 * F.col("failed") + F.when(many, 10).otherwise(0)).alias("minutes"))


@query("intake_manifest", sql("files", """select host, count(*) as files, count(*) filter (where size <= 15000) as valid, count(*) filter (where size > 15000) as invalid,
    coalesce(sum(size) filter (where size <= 15000), 0) as valid_size, (count(*) filter (where size <= 15000) + 24) // 25 as batches, max(path) filter (where size > 15000) as last_invalid from files group by 1"""))
def intake_manifest(spark, d):
    """Valid files in batches of 25 and invalid ones with their error, written as a
    manifest of JSON lines; its summary is taken from what is read back."""
    files = b.files(spark, d).select("host", "file_id", "path", "size")
    good = w.fixed_batches(files.where("size <= 15000"), ["host"], ["file_id"], 25)
    lines = good.groupBy("host", "batch").agg(F.collect_list(F.struct("file_id", "path", "size")).alias("files"))  # 25 at most
    invalid = files.where("size > 15000").select("host", F.lit(-1).cast("long").alias("batch"), F.array(F.struct("file_id", "path", "size")).alias("files"), F.lit("file is too large").alias("error"))
    path = shared_path(spark, "intake-manifest")
    lines.withColumn("error", F.lit(None).cast("string")).unionByName(invalid).write.json(path)
    back = spark.read.schema("host string, batch bigint, error string, files array<struct<file_id: bigint, path: string, size: bigint>>").json(path)
    valid, n = F.col("error").isNull(), F.size("files")
    return back.groupBy("host").agg(
        F.sum(n).alias("files"), F.sum(F.when(valid, n).otherwise(0)).alias("valid"), F.sum(F.when(~valid, n).otherwise(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(valid, F.aggregate("files", F.lit(0).cast("long"), lambda s, x: s + x["size"]))), F.lit(0)).alias("valid_size"), F.count_if(valid).alias("batches"),
        F.max(F.when(~valid, F.col("files")[0]["path"])).alias("last_invalid"))


@query("graph_completeness", sql("chunks scored", """, n as (select document_id, count(*) as chunks, 2 * (count(*) - 1) as expected from chunks group by 1),
    q as (select document_id, count(nxt) * 2 as found from (select document_id, lead(chunk_index) over (partition by document_id order by chunk_index) as nxt from chunks) group by 1),
    r as (select document_id, count(*) as mentions, count(*) filter (where confidence >= 70) as resolved from scored group by 1)
    select document_id, chunks, 1 + chunks as belongs_to, coalesce(mentions, 0) as contains_mention, expected, found, coalesce(resolved * 100.0 / mentions, 100) as resolved,
    found = expected and coalesce(resolved * 100.0 / mentions, 100) >= 70 as complete from n join q using (document_id) left join r using (document_id)"""))
def graph_completeness(spark, d):
    """Edges of each document by family against what its chunks and mentions call
    for; mentions of 70 or more confidence are resolved, and 70 % should be."""
    chunks, scored = b.chunks(spark, d), b.scored(spark, d)
    from folio.operators.graph import structural

    owner = F.regexp_extract("source_id", r"^d(\d+)", 1).cast("long")
    edges = structural(chunks, scored).where("relationship_type <> 'MEMBER_OF_CLUSTER'").groupBy(owner.alias("document_id")).pivot(
        "relationship_type", ["BELONGS_TO", "CONTAINS_MENTION", "NEXT_CHUNK", "PREVIOUS_CHUNK"]).count().na.fill(0)
    n = chunks.groupBy("document_id").agg(F.count("*").alias("chunks"))
    good = scored.groupBy("document_id").agg((F.count_if(F.col("confidence") >= 70) * 100.0 / F.count("*")).alias("resolved"))
    rows = n.join(edges, "document_id").join(good, "document_id", "left").withColumn("resolved", F.coalesce("resolved", F.lit(100.0)))
    found, expected = F.col("NEXT_CHUNK") + F.col("PREVIOUS_CHUNK"), 2 * (F.col("chunks") - 1)
    return rows.select(
        "document_id", "chunks", F.col("BELONGS_TO").alias("belongs_to"), F.col("CONTAINS_MENTION").alias("contains_mention"), expected.alias("expected"), found.alias("found"),
        "resolved", ((found == expected) & (F.col("resolved") >= 70)).alias("complete"))
