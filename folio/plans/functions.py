"""Text-function and name-variation queries, each over a whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import names as n
from folio.functions import text as t
from folio.operators import graph as g
from folio.operators import metrics as m
from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table

_SAFE = "substring(trim(regexp_replace(regexp_replace(path, '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '_'), 1, 200)"


@query("sanitize_filename", sql("files", f"select file_id, {_SAFE} as safe from files"))
def sanitize_filename(spark, d):
    return b.files(spark, d).select("file_id", t.sanitize_filename(F.col("path")).alias("safe"))


@query("clean_component", "select s_suppkey, substring(replace(lower(trim(s_name)), ' ', '_'), 1, 50) as component from supplier")
def clean_component(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", t.clean_component(F.col("s_name")).alias("component"))


@query("name_template", """select p_partkey, case when p_size < 10 then 'small_' || lower(p_brand) || '_' || p_partkey when p_size < 30 then lower(p_type) || '_' || lower(p_brand)
    else 'document_' || p_partkey end as name from part""")
def name_template(spark, d):
    size, key, brand = F.col("p_size"), F.col("p_partkey").cast("string"), F.lower("p_brand")
    name = F.when(size < 10, F.concat_ws("_", F.lit("small"), brand, key)).when(size < 30, F.concat_ws("_", F.lower("p_type"), brand)).otherwise(F.concat_ws("_", F.lit("document"), key))
    return table(spark, d, "part").select("p_partkey", name.alias("name"))


@query("generic_name_check", sql("files", """select file_id, cast(contains(path, 'www') as integer) + cast(contains(path, 'page') as integer) + cast(contains(path, 'example') as integer)
    + cast(contains(path, 'html') as integer) + cast(contains(path, 'ref') as integer) > 2 as generic from files"""))
def generic_name_check(spark, d):
    return b.files(spark, d).select("file_id", n.is_generic(F.col("path"), ("www", "page", "example", "html", "ref"), 2).alias("generic"))


@query("naming_validate", sql("files", f""", s as (select file_id, {_SAFE} as safe from files)
    select file_id, array_to_string(list_filter([case when length(safe) < 30 then 'short' end, case when length(safe) > 60 then 'long' end, case when contains(safe, '?') then 'character' end,
    case when not contains(safe, '.') then 'extension' end, case when count(*) over (partition by safe) > 1 then 'collision' end], lambda v: v is not null), ',') as issues from s"""))
def naming_validate(spark, d):
    return n.naming_issues(b.files(spark, d).select("file_id", t.sanitize_filename(F.col("path")).alias("safe")))


@query("guess_doc_type", "select doc_id, case " + " ".join(
    "when " + " or ".join(f"contains(lower(text), '{p}')" for p in patterns) + f" then '{kind}'" for kind, patterns in n.DOC_TYPES.items()) + " else 'document' end as kind from documents")
def guess_doc_type(spark, d):
    return table(spark, d, "documents").select("doc_id", n.doc_type(F.col("text")).alias("kind"))


@query("parse_date_entity", sql("batches", "select batch_id, cast(created_at as date) as day, year(created_at) as year, month(created_at) as month from batches"))
def parse_date_entity(spark, d):
    formats = F.element_at(F.array(F.lit("yyyy-MM-dd"), F.lit("MMMM d, yyyy"), F.lit("M/d/yyyy")), (F.col("batch_id") % 3 + 1).cast("int"))
    text = F.when(F.col("batch_id") % 3 == 0, F.date_format("created_at", "yyyy-MM-dd")).when(F.col("batch_id") % 3 == 1, F.date_format("created_at", "MMMM d, yyyy")).otherwise(F.date_format("created_at", "M/d/yyyy"))
    rows = b.batches(spark, d).select("batch_id", t.parse_date(text).alias("day"))
    return rows.select("batch_id", "day", F.year("day").alias("year"), F.month("day").alias("month"))


@query("parse_money", sql("batches", "select batch_id, cents / 100.0 as amount from batches"))
def parse_money(spark, d):
    text = F.concat(F.lit("the sum of $"), F.format_number(F.col("cents") / 100.0, 2), F.lit(" is due"))
    return b.batches(spark, d).select("batch_id", t.parse_money(text).alias("amount"))


@query("json_llm_response", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_llm_response(spark, d):
    wrapped = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here is the answer: "), "props", F.lit(" as asked."))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", t.json_response(wrapped, "k bigint")["k"].alias("k"))


#: Categories that a response may name in part.
PRIORITIES = ("urgent", "high", "medium", "low", "not specified")


@query("labelled_response_parse", sql("batches", "select batch_id, case " + " ".join(f"when contains(lower(priority), '{c}') or contains('{c}', lower(priority)) then '{c}'" for c in PRIORITIES)
    + " else 'other' end as category, least(1.0, greatest(0.0, batch_id % 150 / 100.0 - 0.1)) as confidence, 'because of ' || lower(priority) as reasoning from batches"))
def labelled_response_parse(spark, d):
    given = ((F.col("batch_id") % 150) / 100.0 - 0.1).cast("string")
    response = F.concat(F.lit("CATEGORY: "), "priority", F.lit("\nCONFIDENCE: "), given, F.lit("\nREASONING: because of "), F.lower("priority"))
    rows = b.batches(spark, d).select("batch_id", response.alias("r"))
    confidence = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t.labelled_field(F.col("r"), "CONFIDENCE").try_cast("double")))
    named = F.lower(t.labelled_field(F.col("r"), "CATEGORY"))
    category = F.coalesce(*[F.when(named.contains(c) | F.lit(c).contains(named), c) for c in PRIORITIES], F.lit("other"))
    return rows.select("batch_id", category.alias("category"), confidence.alias("confidence"), t.labelled_field(F.col("r"), "REASONING").alias("reasoning"))


_NAMES = """, p as (select distinct document_id, entity_text as name, lag(entity_text) over (partition by document_id, entity_type order by chunk_index, ordinal) as other from mentions where entity_type = 'PERSON')"""


def _neighbours(spark, d):
    from pyspark.sql import Window

    rows = b.mentions(spark, d).where("entity_type = 'PERSON'")
    other = F.lag("entity_text").over(Window.partitionBy("document_id", "entity_type").orderBy("chunk_index", "ordinal"))
    return rows.select("document_id", F.col("entity_text").alias("name"), other.alias("other")).distinct().where("other is not null")


def _similar(a: str, z: str) -> str:
    a, z = f"lower(trim({a}))", f"lower(trim({z}))"
    words = lambda c: f"list_distinct(string_split_regex({c}, '\\s+'))"
    return f"""round(case when {a} = {z} then 1.0 when contains({a}, {z}) or contains({z}, {a}) then 0.9 else greatest(1 - levenshtein({a}, {z}) * 1.0 / greatest(length({a}), length({z})),
        0.8 * len(list_intersect({words(a)}, {words(z)})) / greatest(len({words(a)}), len({words(z)}))) end, 6)"""


@query("string_similarity", sql("mentions", _NAMES + f""" select document_id, name, other, {_similar("name", "other")} as similarity, {_similar("name || ' ' || other", "other || ' ' || name")} as turned from p where other is not null"""))
def string_similarity(spark, d):
    """Of neighbouring names, and of the two of them against the two turned round."""
    both, turned = F.concat_ws(" ", "name", "other"), F.concat_ws(" ", "other", "name")
    return _neighbours(spark, d).withColumns({"similarity": F.round(n.similarity(F.col("name"), F.col("other")), 6), "turned": F.round(n.similarity(both, turned), 6)})


@query("person_variation", sql("mentions", _NAMES + """ select count(*) as pairs, count(*) filter (where substring(name, 1, 1) = substring(other, 1, 1) and right(name, 3) = right(other, 3)) as varied from p where other is not null"""))
def person_variation(spark, d):
    full = lambda c: F.concat(F.substring(c, 1, 1), F.lit(". "), F.right(F.col(c), F.lit(3)))
    flipped = F.concat(F.right(F.col("other"), F.lit(3)), F.lit(", "), F.substring("other", 1, 1), F.lit("."))
    rows = _neighbours(spark, d)
    return rows.agg(F.count("*").alias("pairs"), F.count_if(n.person_variation(full("name"), flipped)).alias("varied"))


@query("org_variation", "select p_partkey, p_brand = 'Brand#2' as same from part")
def org_variation(spark, d):
    a, z = F.concat("p_brand", F.lit(" Corporation")), F.lit("Brand#2 Corp.")
    return table(spark, d, "part").select("p_partkey", n.org_variation(a, z).alias("same"))


@query("date_variation", sql("batches", "select batch_id, month(created_at) >= 10 and day(created_at) >= 10 as same from batches"))
def date_variation(spark, d):
    a, z = F.date_format("created_at", "yyyy/MM/dd"), F.date_format("created_at", "yyyy-M-d")
    return b.batches(spark, d).select("batch_id", n.date_variation(a, z).alias("same"))


@query("eta_minutes", sql("items", """, s as (select batch_id, count(*) as n, count(*) filter (where status <> 'pending') as done, sum(size_mb) as elapsed from items group by 1)
    select batch_id, case when done > 0 then elapsed * 1.0 / done * (n - done) end as eta from s"""))
def eta_minutes(spark, d):
    finished = F.count_if(F.col("status") != "pending")
    s = b.items(spark, d).groupBy("batch_id").agg(F.count("*").alias("n"), finished.alias("done"), F.sum("size_mb").alias("elapsed"))
    return s.select("batch_id", F.when(F.col("done") > 0, F.col("elapsed") / F.col("done") * (F.col("n") - F.col("done"))).alias("eta"))


@query("success_rate", sql("items", """select document_id, coalesce(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*) filter (where status <> 'pending'), 0), 0) as success_rate from items group by 1"""))
def success_rate(spark, d):
    done, failed = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    return b.items(spark, d).groupBy("document_id").agg(m.rate(done, done + failed).alias("success_rate"))


@query("extract_relations_basic", sql("letters", """select letter_id as document_id, customer as source_entity, 'opposing_party' as relationship_type, vendor as target_entity, 0.8 as confidence,
    substring(text, 1, instr(text, vendor) - 1 + 20) as context from letters where letter_id % 4 = 3"""))
def extract_relations_basic(spark, d):
    """Relations between the names in letters; those of other kinds hold none of the four patterns."""
    rows = b.letters(spark, d).select(F.col("letter_id").alias("document_id"), "text", F.array("customer", "vendor", "place", "day").alias("names"))
    return g.word_relations(rows)
