"""Projections, filters and data-quality queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import metrics as m
from folio.operators import rules as r
from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table
from folio.sources import storage as s


def _case(column: str, patterns: dict[str, tuple[str, ...]], default: str) -> str:
    tests = [f"when {' or '.join(f'''contains(lower({column}), '{w.lower()}')''' for w in words)} then '{label}'" for label, words in patterns.items()]
    return f"case {' '.join(tests)} else '{default}' end"


CATEGORY = _case("coalesce(message, '')", r.ERROR_PATTERNS, "permanent")


@query("intake_priority", sql("items", "select case when size_mb < 1 then 'high' when size_mb < 20 then 'normal' else 'low' end as intake_class, count(*) as n, sum(size_mb) as size_mb from items group by 1"))
def intake_priority(spark, d):
    return b.items(spark, d).groupBy(r.intake_priority(F.col("size_mb")).alias("intake_class")).agg(F.count("*").alias("n"), F.sum("size_mb").alias("size_mb"))


@query("intake_complexity", sql("files", """select case when path like '%.html' then 'simple' when size < 5000 then 'standard' else 'complex' end as complexity,
    count(*) as n, sum(size) as size from files group by 1"""))
def intake_complexity(spark, d):
    kind = F.when(F.col("path").endswith(".html"), "simple").when(F.col("size") < 5000, "standard").otherwise("complex")
    return b.files(spark, d).groupBy(kind.alias("complexity")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@query("file_integrity", """select case when html is null then 'missing' when length(html) = 0 then 'empty' when length(html) > 20000 then 'too_large'
    when not starts_with(html, '<!DOCTYPE') then 'bad_header' else 'ok' end as verdict, count(*) as n from pages group by 1""")
def file_integrity(spark, d):
    html = F.col("html")
    verdict = F.coalesce(F.when(html.isNull(), "missing"), F.when(F.length(html) == 0, "empty"), F.when(F.length(html) > 20000, "too_large"),
                         F.when(~html.startswith("<!DOCTYPE"), "bad_header"), F.lit("ok"))
    return table(spark, d, "pages").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("should_process_file", sql("files", "select file_id, size from files where size >= 100 and host not like '%ads-track%' and not regexp_matches(path, '\\.(mp3|mp4|zip)$')"))
def should_process_file(spark, d):
    return b.files(spark, d).where((F.col("size") >= 100) & ~F.col("host").contains("ads-track") & ~F.col("path").rlike(r"\.(mp3|mp4|zip)$")).select("file_id", "size")


_MEDIA = " or ".join([f"lower(path) like '%{e}'" for e in r.MEDIA_ENDINGS] + [f"mime like '{t}%'" for t in r.MEDIA_TYPES])


@query("filter_media_files", sql("records", f"""select count(*) filter (where not media) as files, sum(size) filter (where not media) as size, count(*) filter (where media) as excluded, sum(size) filter (where media) as excluded_size,
    sum(cost_cents) * (count(*) filter (where not media)) / count(*) as cost_cents from (select *, {_MEDIA} as media from records)"""))
def filter_media_files(spark, d):
    return r.without_media(b.records(spark, d))[1]


@query("document_kind_by_name", sql("records", f"select file_id, {_case('split_part(path, chr(47), 2)', r.NAME_KINDS, 'default')} as kind from records"))
def document_kind_by_name(spark, d):
    return b.records(spark, d).select("file_id", r.first_match(F.element_at(F.split("path", "/"), -1), r.NAME_KINDS, "default").alias("kind"))


@query("folder_category", sql("records", f"select file_id, {_case('split_part(path, chr(47), 1)', r.FOLDER_CATEGORIES, 'miscellaneous')} as category from records"))
def folder_category(spark, d):
    return b.records(spark, d).select("file_id", r.first_match(F.split("path", "/")[0], r.FOLDER_CATEGORIES, "miscellaneous").alias("category"))


_NAMED = f"{b._list(b.NAMES)}[doc_id % {len(b.NAMES)} + 1]"


@query("extraction_sufficient", f"""with k as (select doc_id, text, greatest(1, cast(ceil(n_chars / 2000.0) as bigint)) as pages, {_case(_NAMED, r.NAME_KINDS, 'default')} as kind,
        trim(replace(text, '{r.ARTIFACT}', ''), ' ') as clean from documents),
    m as (select *, pages * case kind {" ".join(f"when '{k}' then {n}" for k, n in r.LEAST_CHARS.items())} else {r.LEAST_CHARS_ELSE} end as expected, (length(text) - length(replace(text, '{r.ARTIFACT}', ''))) / {len(r.ARTIFACT)}.0 as artifacts from k),
    v as (select doc_id, case when text is null or text = '' then 'No text extracted' when length(clean) < expected * 0.5 then 'Extracted only ' || length(clean) || ' chars, expected ~' || expected
        when clean in ({", ".join(map(repr, r.TRIVIAL))}) then 'Extraction appears incomplete' when artifacts > pages * 2 then 'Too many OCR artifacts detected' else 'Valid extraction' end as reason from m)
    select doc_id, reason = 'Valid extraction' as sufficient, reason from v""")
def extraction_sufficient(spark, d):
    """Documents under the names of a law office's files; a page has 2,000 characters."""
    name = F.element_at(F.array(*map(F.lit, b.NAMES)), (F.col("doc_id") % len(b.NAMES) + 1).cast("int"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 2000))
    return table(spark, d, "documents").select("doc_id", r.sufficient(F.col("text"), name, pages).alias("v")).select("doc_id", "v.*")


@query("entity_input_valid", "select doc_id from documents where text is not null and regexp_matches(text, '[^ \\t\\n]') and doc_id >= 0 and length(text) >= 50")
def entity_input_valid(spark, d):
    return table(spark, d, "documents").where(F.col("text").rlike("[^ \t\n]") & (F.col("doc_id") >= 0) & (F.length("text") >= 50)).select("doc_id")


_TYPE = "case " + " ".join(f"when upper(kind) in ({', '.join(repr(w) for w in words)}) then '{t}'" for t, words in r.ENTITY_TYPES.items()) + " end"


@query("entity_type_map", sql("mentions", f""", k as (select ['name', 'company', 'city', 'year', 'thing'][length(entity_text) % 5 + 1] as kind from mentions)
    select kind, {_TYPE} as mapped, count(*) as n from k where {_TYPE} is not null group by 1, 2"""))
def entity_type_map(spark, d):
    kinds = F.array(*map(F.lit, ("name", "company", "city", "year", "thing")))
    rows = b.mentions(spark, d).select(kinds[F.length("entity_text") % 5].alias("kind"))
    return rows.withColumn("mapped", r.entity_type_map(F.col("kind"))).where("mapped is not null").groupBy("kind", "mapped").agg(F.count("*").alias("n"))


@query("entity_record_valid", sql("mentions", """select entity_type, confidence, count(*) as n from (select entity_type,
    least(greatest(coalesce(try_cast(case when length(entity_text) % 7 = 0 then 'bad' else cast(length(entity_text) % 4 as varchar) end as double), 0.7), 0), 1) as confidence
    from mentions) group by 1, 2"""))
def entity_record_valid(spark, d):
    n = F.length("entity_text")
    raw = F.when(n % 7 == 0, "bad").otherwise((n % 4).cast("string"))
    confidence = F.least(F.greatest(F.coalesce(raw.try_cast("double"), F.lit(0.7)), F.lit(0.0)), F.lit(1.0))
    return b.mentions(spark, d).groupBy("entity_type", confidence.alias("confidence")).agg(F.count("*").alias("n"))


@query("mention_sanitize", sql("scored", """, m as (select *, ordinal - 1 as a, ordinal + length(entity_text) - (ordinal % 3) * 8 as z, confidence / 60.0 - 0.9 as raw from scored where length(trim(entity_text)) > 0)
    select document_id, chunk_index, entity_type, ordinal, least(1.0, greatest(0.0, raw)) as confidence, case when a < 0 or z <= a then 0 else a end as start,
    case when a < 0 or z <= a then length(entity_text) else z end as stop from m"""))
def mention_sanitize(spark, d):
    """Raw offsets and scores are told from the ordinal, so that some are bad."""
    size = F.length("entity_text")
    rows = b.scored(spark, d).select(
        "document_id", "chunk_index", "entity_type", "ordinal", "entity_text", (F.col("confidence") / 60.0 - 0.9).alias("confidence"),
        (F.col("ordinal") - 1).alias("start"), (F.col("ordinal") + size - (F.col("ordinal") % 3) * 8).alias("stop"))
    return r.sanitized(rows).drop("entity_text")


@query("low_confidence_filter", sql("scored", "select document_id, chunk_index, entity_type, ordinal, confidence from scored where confidence >= 75"))
def low_confidence_filter(spark, d):
    return b.scored(spark, d).where("confidence >= 75").select("document_id", "chunk_index", "entity_type", "ordinal", "confidence")


@query("normalize_entity_text", sql("turns", "select document_id, chunk_index, md5(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'))) as normal from turns"))
def normalize_entity_text(spark, d):
    return b.turns(spark, d).select("document_id", "chunk_index", F.md5(F.trim(F.regexp_replace("text", "[ \t\n\r]+", " "))).alias("normal"))


@query("confidence_level", sql("scored", "select case when confidence / 100.0 > 0.9 then 'high' when confidence / 100.0 > 0.7 then 'medium' else 'low' end as level, count(*) as n from scored group by 1"))
def confidence_level(spark, d):
    return b.scored(spark, d).groupBy(r.confidence_level(F.col("confidence") / 100.0).alias("level")).agg(F.count("*").alias("n"))


@query("enum_check", sql("batches", "select priority, count(*) as n from batches where priority not in ('1-URGENT', '2-HIGH', '5-LOW') group by 1"))
def enum_check(spark, d):
    return b.batches(spark, d).where(~F.col("priority").isin("1-URGENT", "2-HIGH", "5-LOW")).groupBy("priority").agg(F.count("*").alias("n"))


@query("check_constraints", """select rule, count(*) as n from (select l_orderkey, unnest(list_filter([case when not (l_quantity >= 10) then 'quantity' end,
    case when not (l_discount <= 0.05) then 'discount' end, case when not (l_partkey <> l_suppkey) then 'self' end], lambda x: x is not null)) as rule from lineitem) group by 1""")
def check_constraints(spark, d):
    rules = {"quantity": F.col("l_quantity") >= 10, "discount": F.col("l_discount") <= 0.05, "self": F.col("l_partkey") != F.col("l_suppkey")}
    return m.counts_by(r.violations(table(spark, d, "lineitem"), "l_orderkey", rules), "rule")


@query("referential_check", "select l_suppkey, count(*) as n from lineitem where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20) group by 1")
def referential_check(spark, d):
    parents = table(spark, d, "supplier").where("s_nationkey < 20").withColumnRenamed("s_suppkey", "l_suppkey")
    return m.counts_by(r.orphans(table(spark, d, "lineitem"), parents, "l_suppkey"), "l_suppkey")


@query("orphan_cleanup", sql("mentions", """, p as (select distinct doc_id from labels)
    select case when p.doc_id is null then 'orphan' else 'kept' end as state, count(*) as n from mentions left join p on p.doc_id = document_id group by 1"""))
def orphan_cleanup(spark, d):
    known = table(spark, d, "labels").select(F.col("doc_id").alias("document_id")).distinct().withColumn("known", F.lit(True))
    rows = b.mentions(spark, d).join(known, "document_id", "left")
    return rows.groupBy(F.when(F.col("known"), "kept").otherwise("orphan").alias("state")).agg(F.count("*").alias("n"))


@query("unique_check", "select source, md5(text) as digest, count(*) as n from documents group by 1, 2 having count(*) > 1")
def unique_check(spark, d):
    return r.duplicate_keys(table(spark, d, "documents").select("source", F.md5("text").alias("digest")), ["source", "digest"])


@query("schema_conformance", """select 'doc_id' as name, 'present' as state, count(*) filter (where doc_id is null) as nulls, 0 as bad from documents
    union all select 'lang', 'present', count(*) filter (where lang is null), count(*) filter (where lang is not null and try_cast(lang as integer) is null) from documents
    union all select 'title', 'missing', 0, 0 union all select 'text', 'extra', 0, 0 union all select 'source', 'extra', 0, 0 union all select 'n_chars', 'extra', 0, 0""")
def schema_conformance(spark, d):
    return r.conformance(table(spark, d, "documents"), {"doc_id": "bigint", "lang": "int", "title": "string"})


@query("row_validation_report", sql("tasks", """, w as (select *, case when event_id % 17 = 0 then 'malformed' when event_id % 13 = 0 then 'type: k' when event_id % 11 = 0 then 'missing: stage' end as broken from tasks),
    e as (select unnest(case when broken is not null then [broken] else list_filter([case when cents <= 100 then 'rule: too_short' end, case when k >= 95 then 'rule: out_of_range' end], lambda x: x is not null) end) as name from w),
    t as (select count(*) as n, count(*) filter (where broken is null and cents > 100 and k < 95) as good from w),
    r as (select 'all' as name, n from t union all select 'valid', good from t union all select 'invalid', n - good from t union all select name, count(*) from e group by 1)
    select 'tasks' as table, name, r.n, r.n * 100.0 / (select n from t) as share, case name when 'type: k' then 'convert k' when 'missing: stage' then 'add stage' else '' end as fix from r"""))
def row_validation_report(spark, d):
    """Task records as JSON lines, some cut off, of another type or without a
    field, against a declared schema and two rules."""
    tasks, at = b.tasks(spark, d), F.col("event_id")
    told = lambda *columns: F.to_json(F.struct("event_id", *columns, "cents"))
    line = F.when(at % 17 == 0, F.substring(told("stage", "k"), 2, 20)).when(at % 13 == 0, told("stage", F.lit("many").alias("k"))).when(at % 11 == 0, told("k")).otherwise(told("stage", "k"))
    rows = s.checked(tasks.select(line.alias("value")), "event_id long, stage string, k long, cents long", {"too_short": "cents > 100", "out_of_range": "k < 95"})
    return s.validation_report(rows, "tasks")


@query("preflight_checks", """with n as (select doc_id, count(*) as copies from documents group by 1),
    c as (select d.doc_id, d.text is not null as recorded, length(d.text) > 0 as filled, d.n_chars between 100 and 20000 as sized, d.n_chars = length(d.text) as counted, d.source <> 'src0' as active,
    l.doc_id is not null as labelled, copies = 1 as single from documents d left join (select distinct doc_id from labels) l using (doc_id) join n using (doc_id))
    select *, case when not (recorded and filled and single) then 'CRITICAL' when not (active and counted) then 'IMPORTANT' when not (sized and labelled) then 'OPTIONAL' else 'PASSED' end as severity,
    not (recorded and filled and single) as blocked from c""")
def preflight_checks(spark, d):
    """Seven checks of a document in three levels; a failed critical one blocks it."""
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels").select("doc_id").distinct().withColumn("labelled", F.lit(True))
    copies = docs.groupBy("doc_id").agg((F.count("*") == 1).alias("single"))
    size = F.length("text")
    rows = docs.select(
        "doc_id", F.col("text").isNotNull().alias("recorded"), (size > 0).alias("filled"), F.col("n_chars").between(100, 20000).alias("sized"), (F.col("n_chars") == size).alias("counted"),
        (F.col("source") != "src0").alias("active")).join(labels, "doc_id", "left").join(copies, "doc_id").withColumn("labelled", F.coalesce("labelled", F.lit(False)))
    critical = ~(F.col("recorded") & F.col("filled") & F.col("single"))
    level = F.when(critical, "CRITICAL").when(~(F.col("active") & F.col("counted")), "IMPORTANT").when(~(F.col("sized") & F.col("labelled")), "OPTIONAL").otherwise("PASSED")
    return rows.withColumns({"severity": level, "blocked": critical})


@query("manifest_validate", sql("files", """, dup as (select content_hash from files group by 1 having count(*) > 1), listed as (select distinct file_id + 7 as file_id from files),
    f as (select file_id, false as missing, size > 15000 as oversized, content_hash in (select content_hash from dup) as duplicated, size * 15 as cost from files)
    select * from f where oversized or duplicated union all select file_id, true, false, false, 0 from listed where file_id not in (select file_id from files)"""))
def manifest_validate(spark, d):
    """Files that are listed but missing (the list is shifted by seven), too large
    or repeated, and what they would cost."""
    files = b.files(spark, d)
    dup = r.duplicate_keys(files, ["content_hash"]).select("content_hash", F.lit(True).alias("duplicated"))
    rows = files.join(dup, "content_hash", "left").withColumn("duplicated", F.coalesce("duplicated", F.lit(False)))
    found = rows.select("file_id", F.lit(False).alias("missing"), (F.col("size") > 15000).alias("oversized"), "duplicated", (F.col("size") * 15).alias("cost")).where("oversized or duplicated")
    listed = files.select((F.col("file_id") + 7).alias("file_id")).distinct()
    no = F.lit(False)
    return found.union(r.orphans(listed, files, "file_id").select("file_id", F.lit(True), no, no, F.lit(0).cast("long")))


@query("status_fold", """select case when contains(s, 'fail') or contains(s, 'error') then 'failed' when contains(s, 'complet') or contains(s, 'success') or s = 'purchase' then 'completed'
    when s in ('', 'pending', 'started') then 'pending' else 'processing' end as folded, count(*) as n from (select lower(event_type) as s from events) group by 1""")
def status_fold(spark, d):
    raw = F.when(F.col("event_type") == "purchase", "completed").otherwise(F.col("event_type"))
    return table(spark, d, "events").groupBy(r.status_fold(raw).alias("folded")).agg(F.count("*").alias("n"))


WORDS = {"ocr": ("ocr", "page"), "storage": ("bucket",), "network": ("connection", "timeout"), "validation": ("validation", "header")}


@query("failure_stage", sql("tasks", f"select {_case('message', WORDS, 'unknown')} as guessed, count(*) as n from tasks where message is not null group by 1"))
def failure_stage(spark, d):
    return b.tasks(spark, d).where("message is not null").groupBy(r.first_match(F.col("message"), WORDS, "unknown").alias("guessed")).agg(F.count("*").alias("n"))


@query("error_category", sql("tasks", f"select message, {CATEGORY} as category, count(*) as n from tasks where message is not null group by 1, 2"))
def error_category(spark, d):
    return b.tasks(spark, d).where("message is not null").groupBy("message", r.error_category(F.col("message")).alias("category")).agg(F.count("*").alias("n"))


BUCKETS = {"timeout": ("timeout",), "memory": ("memory",), "access": ("denied", "permission"), "format": ("corrupt", "validation"), "throttled": ("429", "toomany")}


@query("error_bucket", sql("tasks", f"select case when message is null then 'Unknown' else {_case('message', BUCKETS, 'Other')} end as bucket, count(*) as n from tasks group by 1"))
def error_bucket(spark, d):
    bucket = F.when(F.col("message").isNull(), "Unknown").otherwise(r.first_match(F.col("message"), BUCKETS, "Other"))
    return b.tasks(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("error_classify_retryable", sql("tasks", f"""select stage, {CATEGORY} in ('transient', 'resource', 'rate_limit') as retryable, count(*) as n
    from tasks where message is not null group by 1, 2"""))
def error_classify_retryable(spark, d):
    retryable = r.error_category(F.col("message")).isin("transient", "resource", "rate_limit")
    return b.tasks(spark, d).where("message is not null").groupBy("stage", retryable.alias("retryable")).agg(F.count("*").alias("n"))


@query("retry_strategy", sql("tasks", f""", c as (select event_id, {CATEGORY} as category, k % 8 as tries from tasks where message is not null)
    select event_id, category, tries, case category when 'transient' then case when tries < 3 then 'immediate' when tries < 6 then 'exponential' else 'manual' end
      when 'resource' then 'linear' when 'rate_limit' then 'exponential' else 'manual' end as strategy,
    cast(case category when 'transient' then case when tries between 3 and 5 then pow(2, tries - 2) else 0 end when 'resource' then 60 * (tries + 1)
      when 'rate_limit' then least(3600, 60 * pow(2, tries)) else 0 end as bigint) as delay from c"""))
def retry_strategy(spark, d):
    rows = b.tasks(spark, d).where("message is not null").select("event_id", r.error_category(F.col("message")).alias("category"), (F.col("k") % 8).alias("tries"))
    return rows.withColumn("s", r.retry_strategy(F.col("category"), F.col("tries"))).select("event_id", "category", "tries", "s.strategy", "s.delay")


@query("retry_backoff", sql("tasks", "select k % 8 as tries, cast(least(60, 5 * pow(2, k % 8)) as bigint) as delay, count(*) as n from tasks group by 1, 2"))
def retry_backoff(spark, d):
    rows = b.tasks(spark, d).select((F.col("k") % 8).alias("tries"))
    return rows.groupBy("tries", r.retry_backoff(F.col("tries")).alias("delay")).agg(F.count("*").alias("n"))


LAST = ", last as (select *, row_number() over (partition by document_id order by ts desc, event_id desc) as rn from tasks)"


@query("stuck_documents", sql("tasks", LAST + """ select document_id, stage, ts from last where rn = 1 and status = 'started'
    and ts < (select max(ts) from tasks) - interval 30 minute"""))
def stuck_documents(spark, d):
    from folio.operators.windows import latest_by

    tasks = b.tasks(spark, d)
    as_of = F.broadcast(tasks.agg(F.max("ts").alias("as_of")))  # one row
    rows = latest_by(tasks, ["document_id"], ["ts", "event_id"]).where("status = 'started'")
    return rows.join(as_of, F.col("ts") < F.col("as_of") - F.expr("INTERVAL 30 MINUTES")).select("document_id", "stage", "ts")


@query("failed_documents", sql("tasks", "select event_id, document_id, stage from tasks where status = 'failed' and ts > (select max(ts) from tasks) - interval 48 hour"))
def failed_documents(spark, d):
    return m.within_hours(b.tasks(spark, d), 48).where("status = 'failed'").select("event_id", "document_id", "stage")


@query("reset_failed", sql("tasks", """, f as (select event_id from tasks where status = 'failed' order by ts, event_id limit 100)
    select t.event_id, case when f.event_id is null then status else 'pending' end as status, case when f.event_id is null then message end as message
    from tasks t left join f using (event_id)"""))
def reset_failed(spark, d):
    tasks = b.tasks(spark, d)
    chosen = tasks.where("status = 'failed'").orderBy("ts", "event_id").limit(100).select("event_id", F.lit(True).alias("chosen"))
    rows = tasks.join(chosen, "event_id", "left")
    return rows.select("event_id", F.when(F.col("chosen"), "pending").otherwise(F.col("status")).alias("status"), F.when(F.col("chosen").isNull(), F.col("message")).alias("message"))


@query("recent_failures", sql("tasks", """select event_id, stage, substring(message, 1, 15) as message from tasks where status = 'failed'
    and ts > (select max(ts) from tasks) - interval 72 hour order by ts desc, event_id limit 20"""))
def recent_failures(spark, d):
    rows = m.within_hours(b.tasks(spark, d), 72).where("status = 'failed'").orderBy(F.desc("ts"), "event_id").limit(20)
    return rows.select("event_id", "stage", F.substring("message", 1, 15).alias("message"))
