"""How the engine's notions are read off the given tables, in Spark and in SQL.

Each binding is a function to a DataFrame and a common table expression of the
same name and columns, so that a query and its oracle start from equal rows.
Amounts are kept in whole cents, so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.chunking import chunk_fixed
from folio.plans.registry import table

#: The stages of document processing, in order.
STAGES = ["intake", "ocr", "chunking", "entity_extraction", "entity_resolution", "relationship_building"]
MESSAGES = [
    "ConnectionError: connection reset",
    "MemoryError while reading page",
    "PermissionDenied for bucket",
    "CorruptFile: bad header",
    "429 TooManyRequests",
    "ocr job not found",
    "ValidationError: missing text",
    "TimeoutError after 30 seconds",
]
TYPES = {"EMAIL": r"[a-z0-9.]+@[a-z0-9.]+", "NUMBER": r"[0-9]{4,}", "PERSON": r"\b[A-Z][a-z]{6,}"}
#: Names that records of a law office's files are told with.
FOLDERS = ("Pleadings 2024", "Medical", "Health Records", "DISCOVERY", "Correspondence", "Exhibits A-C", "Depositions", "Expert reports", "Financial", "Misc")
NAMES = ("Tax_Return", "Form_1040", "Death_Certificate", "gmail_export", "Affidavit", "Final_Order", "Invoice", "Warranty_Deed", "photo", "Schedule_C", "Birth", "notes", "Complaint")
EXTENSIONS = {
    ".pdf": "application/pdf", ".MOV": "video/quicktime", ".mp3": "audio/mpeg", ".docx": "application/msword", ".txt": "text/plain", ".wav": "application/pdf", ".jpg": "image/jpeg",
    ".eml": "message/rfc822", ".mp4": "video/mp4", ".dat": "audio/basic", ".avi": "video/avi",
}


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


CTE = {
    "tasks": f"""tasks as (select event_id, ts, user_id as document_id, user_id % 10 as batch_id, user_id % 4 as project_id,
        {_list(STAGES)}[event_id % 6 + 1] as stage,
        case event_type when 'error' then 'failed' when 'view' then 'started' else 'completed' end as status,
        case when event_type = 'error' then {_list(MESSAGES)}[event_id % 8 + 1] end as message,
        cast(round(value * 100) as bigint) as cents, cast(json_extract_string(props, '$.k') as bigint) as k from events)""",
    "chunks": """chunks as (select doc_id as document_id, source, lang, k as chunk_index,
        substring(text, cast(k * 800 + 1 as bigint), 1000) as chunk_text, k * 800 as char_start,
        least(k * 800 + 1000, length(text)) as char_end
        from (select *, unnest(range(0, 1 + cast(ceil(greatest(length(text) - 1000, 0) / 800.0) as bigint))) as k
              from documents where length(text) > 0))""",
    "mentions": "mentions as ("
    + " union all ".join(
        f"""select document_id, source, lang, chunk_index, '{t}' as entity_type, generate_subscripts(m, 1) - 1 as ordinal,
        unnest(m) as entity_text from (select *, regexp_extract_all(chunk_text, '{p}') as m from chunks)"""
        for t, p in TYPES.items()
    )
    + ")",
    "scored": """scored as (select *, case entity_type when 'EMAIL' then 95 when 'NUMBER' then 80
        else 50 + 2 * least(length(entity_text), 20) end as confidence,
        entity_type || ':' || lower(entity_text) as canonical_id from mentions)""",
    "batches": """batches as (select o_orderkey as batch_id, o_custkey as project_id, o_orderpriority as priority,
        case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else 'processing' end as status,
        cast(round(o_totalprice * 100) as bigint) as cents, o_orderdate as created_at from orders)""",
    "items": """items as (select l_orderkey as batch_id, l_linenumber as item, l_partkey as document_id,
        cast(l_quantity as bigint) as size_mb, cast(round(l_extendedprice * 100) as bigint) as cents,
        case l_returnflag when 'R' then 'failed' when 'A' then 'completed' else 'pending' end as status,
        l_shipdate as updated_at from lineitem)""",
    "files": """files as (select page_id as file_id, url as path, sha256(html) as content_hash, length(html) as size,
        regexp_extract(url, '://([^/?#]*)', 1) as host from pages)""",
    "letters": """letters as (select letter_id, customer, vendor, place, day, case letter_id % 4
        when 0 then 'AGREEMENT dated ' || day || chr(10) || 'Contract between ' || customer || ' and ' || vendor || ' under the laws of the State of ' || place || '. The amount of $' || amount
            || ' is due, pursuant to Section 5 of the terms; see Case No. ' || letter_id || '.'
        when 1 then 'COMPLAINT of ' || day || chr(10) || 'The plaintiff alleges that ' || customer || ' owes ' || vendor || ' the amount of $' || amount || '. On or about the first day, ' || customer || ' paid $'
            || amount || ' to ' || vendor || '. See 12-cv-' || (10000 + letter_id % 1000) || ', United States District Court.'
        when 2 then 'Dear Sir, ' || customer || ' works for ' || vendor || ' based in ' || place || ', County of Kings. ' || customer || ' joined on ' || day || '. Sincerely'
        else customer || ' v. ' || vendor || ', 42 U.S.C. § 1983, in the Ninth Circuit' || chr(10) || 'The motion was filed on ' || day || ' by counsel.' end as text
        from (select o_orderkey as letter_id, 'Customer' || o_custkey as customer, 'Vendor' || (o_orderkey % 97) as vendor, 'Ohio' as place,
            case o_orderkey % 4 when 0 then month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) when 2 then month(o_orderdate) || '-' || day(o_orderdate) || '-' || year(o_orderdate)
            else monthname(o_orderdate) || ' ' || day(o_orderdate) || ', ' || year(o_orderdate) end as day,
            cast(round(o_totalprice * 100) as bigint) // 100 || '.' || lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as varchar), 2, '0') as amount from orders))""",
    "writings": """writings as (select 'document' as kind, doc_id as id, text from documents where text is not null union all select 'letter', letter_id, text from letters)""",
    "records": f"""records as (select o_orderkey as file_id, {_list(FOLDERS)}[o_orderkey % {len(FOLDERS)} + 1] || '/' || {_list(NAMES)}[o_orderkey % {len(NAMES)} + 1] || '_' || o_orderkey || extension as path,
        case when o_orderkey % 23 = 0 then 'application/octet-stream' else mime end as mime, cents as size, cents % 1000 as cost_cents
        from (select *, {_list(EXTENSIONS)}[o_orderkey % {len(EXTENSIONS)} + 1] as extension, {_list(EXTENSIONS.values())}[o_orderkey % {len(EXTENSIONS)} + 1] as mime, cast(round(o_totalprice * 100) as bigint) as cents from orders))""",
    "turns": "turns as (select conv_id as document_id, turn as chunk_index, role, text from conversations)",
}
_NEEDS = {"mentions": ["chunks"], "scored": ["chunks", "mentions"], "writings": ["letters"]}


def sql(names: str, body: str) -> str:
    """The query over the named bindings, as one statement."""
    wanted: list[str] = []
    for name in names.split():
        for part in [*_NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    return "with " + ",\n".join(CTE[n] for n in wanted) + "\n" + body


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage runs: one event for each document, stage and attempt."""
    e = table(spark, sf_dir, "events")
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % n + 1).cast("int"))
    return e.select(
        "event_id",
        "ts",
        F.col("user_id").alias("document_id"),
        (F.col("user_id") % 10).alias("batch_id"),
        (F.col("user_id") % 4).alias("project_id"),
        pick(STAGES, 6).alias("stage"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "started").otherwise("completed").alias("status"),
        F.when(F.col("event_type") == "error", pick(MESSAGES, 8)).alias("message"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_fixed(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), "source", "lang", "text"))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-based mentions in chunks, by type and order in the chunk."""
    found = F.array(*[F.struct(F.lit(t).alias("entity_type"), F.regexp_extract_all("chunk_text", F.lit(p), F.lit(0)).alias("m")) for t, p in TYPES.items()])
    rows = chunks(spark, sf_dir).select("document_id", "source", "lang", "chunk_index", F.inline(found))
    return rows.select("document_id", "source", "lang", "chunk_index", "entity_type", F.posexplode("m").alias("ordinal", "entity_text")).withColumn(
        "ordinal", F.col("ordinal").cast("long")
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions with a confidence in hundredths and their canonical id."""
    confidence = F.when(F.col("entity_type") == "EMAIL", 95).when(F.col("entity_type") == "NUMBER", 80)
    confidence = confidence.otherwise(50 + 2 * F.least(F.length("entity_text"), F.lit(20)))
    return mentions(spark, sf_dir).withColumns(
        {"confidence": confidence, "canonical_id": F.concat_ws(":", "entity_type", F.lower("entity_text"))}
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("processing")
    return o.select(
        F.col("o_orderkey").alias("batch_id"),
        F.col("o_custkey").alias("project_id"),
        F.col("o_orderpriority").alias("priority"),
        status.alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.col("o_orderdate").alias("created_at"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_returnflag") == "A", "completed").otherwise("pending")
    return i.select(
        F.col("l_orderkey").alias("batch_id"),
        F.col("l_linenumber").alias("item"),
        F.col("l_partkey").alias("document_id"),
        F.col("l_quantity").cast("long").alias("size_mb"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        status.alias("status"),
        F.col("l_shipdate").alias("updated_at"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").alias("file_id"),
        F.col("url").alias("path"),
        F.sha2("html", 256).alias("content_hash"),
        F.length("html").cast("long").alias("size"),
        F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a law office, with folders, names and types told from the orders."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    path = F.concat(pick(FOLDERS), F.lit("/"), pick(NAMES), F.lit("_"), key.cast("string"), pick(EXTENSIONS))
    mime = F.when(key % 23 == 0, "application/octet-stream").otherwise(pick(list(EXTENSIONS.values())))
    return o.select(key.alias("file_id"), path.alias("path"), mime.alias("mime"), cents.alias("size"), (cents % 1000).alias("cost_cents"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("chunk_index"), "role", "text")


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short legal letter told from each order, with the names that stand in it."""
    o, key = table(spark, sf_dir, "orders"), F.col("letter_id")
    cents, date, on = F.round(F.col("o_totalprice") * 100).cast("long"), F.col("o_orderdate"), F.col("o_orderkey") % 4
    parts = [F.month(date).cast("string"), F.day(date).cast("string"), F.year(date).cast("string")]
    day = F.when(on == 0, F.concat_ws("/", *parts)).when(on == 2, F.concat_ws("-", *parts)).otherwise(F.date_format(date, "MMMM d, yyyy"))
    amount = F.concat_ws(".", F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0"))
    rows = o.select(
        F.col("o_orderkey").alias("letter_id"), F.concat(F.lit("Customer"), "o_custkey").alias("customer"), F.concat(F.lit("Vendor"), F.col("o_orderkey") % 97).alias("vendor"),
        F.lit("Ohio").alias("place"), day.alias("day"), amount.alias("amount"))
    agreement = F.concat(F.lit("AGREEMENT dated "), "day", F.lit("\nContract between "), "customer", F.lit(" and "), "vendor", F.lit(" under the laws of the State of "), "place",
        F.lit(". The amount of $"), "amount", F.lit(" is due, pursuant to Section 5 of the terms; see Case No. "), key, F.lit("."))
    complaint = F.concat(F.lit("COMPLAINT of "), "day", F.lit("\nThe plaintiff alleges that "), "customer", F.lit(" owes "), "vendor", F.lit(" the amount of $"), "amount", F.lit(". On or about the first day, "),
        "customer", F.lit(" paid $"), "amount", F.lit(" to "), "vendor", F.lit(". See 12-cv-"), 10000 + key % 1000, F.lit(", United States District Court."))
    letter = F.concat(F.lit("Dear Sir, "), "customer", F.lit(" works for "), "vendor", F.lit(" based in "), "place", F.lit(", County of Kings. "), "customer", F.lit(" joined on "), "day", F.lit(". Sincerely"))
    motion = F.concat("customer", F.lit(" v. "), "vendor", F.lit(", 42 U.S.C. § 1983, in the Ninth Circuit\nThe motion was filed on "), "day", F.lit(" by counsel."))
    text = F.when(key % 4 == 0, agreement).when(key % 4 == 1, complaint).when(key % 4 == 2, letter).otherwise(motion)
    return rows.select("letter_id", "customer", "vendor", "place", "day", text.alias("text"))


def writings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and letters."""
    documents = table(spark, sf_dir, "documents").where("text is not null").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    return documents.unionByName(letters(spark, sf_dir).select(F.lit("letter").alias("kind"), F.col("letter_id").alias("id"), "text"))
