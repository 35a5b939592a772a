"""Chunking, extraction, text-quality and scoring queries, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from folio.functions import text as t
from folio.operators import chunking as c
from folio.operators import extract as x
from folio.operators import checks as q
from folio.operators import metrics as m
from folio.plans import bindings as b
from folio.plans.bindings import sql
from folio.plans.registry import query, table


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@query("chunk_fixed", sql("chunks", "select document_id, chunk_index, char_start, char_end, md5(chunk_text) as digest from chunks"))
def chunk_fixed(spark, d):
    return b.chunks(spark, d).select("document_id", "chunk_index", "char_start", "char_end", F.md5("chunk_text").alias("digest"))


_QUALITY = """, r as (select *, length(chunk_text) as size, lead(char_start) over (partition by document_id order by chunk_index) - char_end as gap from chunks),
    s as (select document_id, count(*) as chunk_count, sum(size) as total_size, min(size) as min_size, max(size) as max_size, sum(size * size) as squares, max(char_end) as text_size,
    sum(size) * 1.0 / count(*) as avg_size, count(*) filter (where length(trim(chunk_text)) = 0) as empty_chunks, sum(greatest(-coalesce(gap, 0), 0)) as shared,
    count(*) filter (where size < 50) as small_chunks, count(*) filter (where not regexp_matches(rtrim(chunk_text), '[.!?:;"'')\\]]\\z')) as mid_sentence,
    count(*) filter (where gap < 0) as overlapping from r group by 1)"""


@query("chunk_quality", sql("chunks", _QUALITY + """ select document_id, chunk_count, total_size, min_size, max_size, text_size, avg_size, empty_chunks, small_chunks, mid_sentence, overlapping,
    sqrt(greatest(chunk_count * squares - total_size * total_size, 0)) / chunk_count as std_size, (total_size - shared) * 1.0 / text_size as coverage,
    array_to_string(list_filter([case when empty_chunks > 0 then 'empty' end, case when small_chunks > 0 then 'small' end, case when mid_sentence > 0 then 'mid_sentence' end, case when overlapping > 0 then 'overlap' end,
    case when chunk_count * squares - total_size * total_size > total_size * total_size / 4.0 then 'uneven' end], lambda v: v is not null), ',') as issues from s"""))
def chunk_quality(spark, d):
    return c.chunk_quality(b.chunks(spark, d))


@query("chunk_quality_score", sql("chunks", _QUALITY + " select document_id, greatest(0.0, least(1.0, (1 - small_chunks / chunk_count) * (1 - 0.5 * (mid_sentence / chunk_count)))) as score from s"))
def chunk_quality_score(spark, d):
    return c.chunk_quality_score(c.chunk_quality(b.chunks(spark, d)))


def _matches(column: str, patterns) -> str:
    return " + ".join(f"len(regexp_extract_all({column}, '{p}'))" for p in patterns)


_COUNTED = ", ".join(f"{_matches('chunk_text', patterns)} as {kind}" for kind, patterns in x.ELEMENTS.items())


@query("chunk_enrich", sql("chunks", f""", e as (select document_id, chunk_index, {_COUNTED}, len(regexp_extract_all(chunk_text, '[^ \\t\\n\\r\\f\\x0B]+')) as words, len(regexp_extract_all(chunk_text, '[.!?]')) as sentences,
    len(list_filter(regexp_extract_all(chunk_text, '[^ \\t\\n\\r\\f\\x0B]+'), lambda w: lower(w) in {x.LEGAL_TERMS})) as terms from chunks)
    select * exclude (terms), least(1.0, citations * 100 / greatest(words, 1) * 0.3 + dates * 100 / greatest(words, 1) * 0.1
    + case when case when sentences > 0 then words / sentences else words end > 15 then 1.0 else 0.5 end * 0.3 + terms / greatest(words, 1) * 0.3) as density,
    'doc' || document_id || '_chunk_' || lpad(cast(chunk_index as varchar), 4, '0') as chunk_id from e"""))
def chunk_enrich(spark, d):
    return x.enrich_chunks(b.chunks(spark, d))


_LINE_TYPE = "case " + " ".join(f"when contains(upper(v), '{w}') then '{k}'" for w, k in x.LINE_TYPES.items()) + " end"


@query("document_structure", f"""with l as (select doc_id, text, list_transform(string_split(text, chr(10))[1:100], lambda v: regexp_replace(v, '^\\s+|\\s+$', '', 'g')) as v from documents),
    k as (select *, list_filter(list_transform(v, lambda v: {_LINE_TYPE}), lambda y: y is not null) as kinds from l)
    select doc_id, len(string_split(text, chr(10))) as lines, len(regexp_extract_all(text, '[^ \\t\\n]+')) as words, length(text) // 4 as tokens,
    len(list_filter(v, lambda y: regexp_matches(y, '^\\d+\\.\\s+'))) > 0 as numbered, len(list_filter(v, lambda y: regexp_matches(y, '^[IVX]+\\.\\s+'))) > 0 as roman,
    len(list_filter(v, lambda y: regexp_matches(y, '^[a-z]\\.\\s+'))) > 0 as lettered, len(string_split(text, '{x.PAGE_END}')) as pages, coalesce(kinds[-1], 'unknown') as likely_type from k""")
def document_structure(spark, d):
    return x.document_structure(_docs(spark, d))


@query("clean_text", """select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<\\|im_end\\|>', '', 'g'), '[ \\t\\n\\r\\f\\v]{3,}', chr(10) || chr(10), 'g'),
    '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g')) as digest from documents""")
def clean_text(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(t.clean_text(F.col("text"))).alias("digest"))


@query("strip_markdown")
def strip_markdown(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(t.strip_markdown(F.col("text"))).alias("digest"))


@query("simple_markdown")
def simple_markdown(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(t.simple_markdown(F.regexp_replace("text", "\n", "\n\n"))).alias("digest"))


@query("chunk_markdown")
def chunk_markdown(spark, d):
    rows = _docs(spark, d).withColumn("guide", F.regexp_replace("text", "\n", "\n\n# "))
    return x.chunk_markdown(rows, 100).select("doc_id", "chunk_index", "char_start", "char_end", F.md5("chunk_text").alias("digest"))


@query("chunk_merge_small")
def chunk_merge_small(spark, d):
    turns = b.turns(spark, d).groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda v: v["text"]).alias("parts"))
    return turns.select("document_id", F.posexplode(x.merge_small(F.col("parts"), 400)).alias("chunk_index", "text")).select("document_id", "chunk_index", F.length("text").alias("size"), F.md5("text").alias("digest"))


@query("chunk_fallback")
def chunk_fallback(spark, d):
    return x.chunk_fallback(_docs(spark, d)).select("doc_id", "method", "chunk_index", F.md5("chunk_text").alias("digest"))


@query("chunk_semantic")
def chunk_semantic(spark, d):
    chunks = x.chunk_semantic(_docs(spark, d).select("doc_id", "text"))
    return chunks.select("doc_id", "chunk_index", "char_start", "char_end", "kind", "line_count", "has_citations", "has_list", "has_signature", F.md5("chunk_text").alias("digest"))


@query("regex_find_all", """select doc_id, m as match, instr(text, m) - 1 as first_start from (select doc_id, text, unnest(list_distinct(regexp_extract_all(text, '[a-z0-9.]+@[a-z0-9.]+'))) as m from documents)""")
def regex_find_all(spark, d):
    rows = _docs(spark, d).select("doc_id", F.inline(t.find_all(F.col("text"), r"[a-z0-9.]+@[a-z0-9.]+")))
    return rows.groupBy("doc_id", "match").agg(F.min("start").alias("first_start"))


@query("word_line_page_counts", """select doc_id, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')) as words, length(text) - length(replace(text, chr(10), '')) as newlines, length(text) // 4 as tokens from documents""")
def word_line_page_counts(spark, d):
    n = F.length("text")
    return _docs(spark, d).select("doc_id", t.word_count(F.col("text")).alias("words"), (n - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("newlines"), F.floor(n / 4).alias("tokens"))


@query("text_hash", "select doc_id, sha256(text) as sha, md5(text) as md5 from documents")
def text_hash(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md5"))


@query("semantic_name", sql("files", """, s as (select file_id, trim(substring(regexp_replace(regexp_replace(path, '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g'), 1, 200), '_') as safe,
    host from files) select file_id, safe, replace(lower(trim(host)), ' ', '_') || '_' || file_id as name, contains(safe, 'utm') or contains(safe, 'page') as generic,
    case when contains(safe, 'utm') or contains(safe, 'page') then 0.45 else 0.9 end as confidence from s"""))
def semantic_name(spark, d):
    return x.semantic_names(b.files(spark, d))


#: A character six times, for an engine without back references: Latin letters and signs.
_SIX = "|".join(f"\\x{{{i:X}}}{{6,}}" for i in (9, *range(0x20, 0x7F), *range(0xA1, 0x180)))
_MARKED = f"""with d as (select doc_id, text, 40 + doc_id % 60 as confidence, doc_id % 3 = 0 as scanned, length(text) as size, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as solid from documents),
    a as (select *, list_filter([case when length(solid) = 0 then ['empty', 'critical'] end, case when length(solid) between 1 and 49 then ['short', 'high'] end, case when confidence < 50 then ['low_confidence', 'high'] end,
    case when confidence between 50 and 69 then ['medium_confidence', 'medium'] end, case when regexp_matches(text, '{_SIX}') then ['repeated', 'medium'] end,
    case when len(regexp_extract_all(text, '[^ -~\\n\\r\\t]')) * 20 > length(text) then ['non_printable', 'medium'] end,
    case when len(list_filter(string_split(text, chr(10)), lambda l: length(l) > 500)) * 10 > len(string_split(text, chr(10))) then ['long_lines', 'low'] end,
    case when len(regexp_extract_all(text, '\\p{{L}}')) * 10 < 3 * length(text) then ['few_letters', 'medium'] end], lambda v: v is not null) as found from d),
    g as (select *, len(found) as n, len(list_filter(found, lambda v: v[2] in ('high', 'critical'))) > 0 as grave from a),
    s as (select *, least(100, greatest(0, 100 - case when size < 50 then 30 when size < 200 then 15 else 0 end - case when confidence < 50 then 40 when confidence < 70 then 20 when confidence < 90 then 10 else 0 end
    - 10 * n - case when scanned then 5 else 0 end)) as score, length(solid) > 0 and confidence >= 70 and size >= 50 and not grave as passed,
    list_filter([case when size < 50 then 'verify the content' end, case when confidence < 70 then 'try another method' end, case when grave then 'review by hand' end,
    case when scanned and confidence < 80 then 'enhance the image' end, case when n > 3 then 'review the process' end], lambda v: v is not null) as advice from g)"""


def _marked(spark, d):
    """Texts with a confidence and a method told from their ids."""
    docs = _docs(spark, d).select("doc_id", "text", (40 + F.col("doc_id") % 60).alias("confidence"), (F.col("doc_id") % 3 == 0).alias("scanned"))
    return x.text_anomalies(docs)


@query("ocr_anomalies", _MARKED + " select doc_id, array_to_string(list_transform(found, lambda v: v[1] || ':' || v[2]), ',') as anomalies from a")
def ocr_anomalies(spark, d):
    return _marked(spark, d).select("doc_id", F.array_join(F.transform("anomalies", lambda a: F.concat_ws(":", a["name"], a["severity"])), ",").alias("anomalies"))


@query("ocr_quality_score", _MARKED + " select doc_id, score from s")
def ocr_quality_score(spark, d):
    return x.quality_scores(_marked(spark, d)).select("doc_id", "score")


@query("ocr_validation", _MARKED + " select doc_id, passed, array_to_string(case when len(advice) > 0 then advice else ['successful'] end, '; ') as advice from s")
def ocr_validation(spark, d):
    return x.quality_scores(_marked(spark, d)).select("doc_id", "passed", F.array_join("advice", "; ").alias("advice"))


#: Matches of a rule, and where they start: behind what stands between the ones before.
_RULED = " union all ".join(f"""select kind, id, '{k}' as entity_type, {confidence} as confidence, regexp_extract_all(text, '{p}') as m, string_split_regex(text, '{p}') as between from writings"""
    for k, (p, confidence) in x.RULES.items())


@query("extract_rule_entities", sql("writings", f""", r as ({_RULED}), p as (select *, unnest(range(1, len(m) + 1)) as i from r),
    s as (select *, cast(list_sum(list_transform(between[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) as bigint) as start from p)
    select kind, id, entity_type, m[i] as entity_text, start, start + length(m[i]) as stop, confidence from s"""))
def extract_rule_entities(spark, d):
    return x.rule_entities(b.writings(spark, d).withColumnRenamed("text", "chunk_text"))


@query("extract_proper_nouns")
def extract_proper_nouns(spark, d):
    return x.proper_nouns(b.chunks(spark, d))


_ALL = ", ".join(f"regexp_extract_all(text, '{p}') as {k}" for k, p in x.FALLBACK.items())


@query("extract_fallback_structured", sql("writings", f""", f as (select kind, id, {_ALL}, len(list_filter(regexp_extract_all(text, '{x.WORD}'), lambda w: regexp_matches(w, '^\\p{{Lu}}') and length(w) > 2)) as names from writings)
    select kind, id, names, dates[1] as date, case_numbers[1] as case_number, array_to_string(dates, ';') as dates, array_to_string(amounts, ';') as amounts, array_to_string(case_numbers, ';') as case_numbers from f"""))
def extract_fallback_structured(spark, d):
    rows = x.fallback_structured(b.writings(spark, d))
    return rows.select("kind", "id", "names", "date", "case_number", *[F.array_join(k, ";").alias(k) for k in x.FALLBACK])


_HINT = "case " + " ".join(f"when regexp_matches(lower(text), '{'|'.join(words)}') then '{k}'" for k, words in x.TYPE_HINTS.items()) + " end"
_COURT = "coalesce(" + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '')" for p in x.JURISDICTIONS) + ")"


@query("extract_metadata", sql("writings", f""", p as (select kind, id, text, list_transform(regexp_extract_all(text, '{x.NUMERIC_DATE}'), lambda v: string_split(replace(v, '-', '/'), '/')) as numeric,
    regexp_extract_all(text, '{x.NAMED_DATE}') as named from writings),
    k as (select *, list_transform(list_filter(numeric, lambda v: length(v[3]) <> 3), lambda v: [case when length(v[3]) = 4 then cast(v[3] as integer) when cast(v[3] as integer) < 69 then 2000 + cast(v[3] as integer)
        else 1900 + cast(v[3] as integer) end, case when cast(v[1] as integer) > 12 then cast(v[2] as integer) else cast(v[1] as integer) end, case when cast(v[1] as integer) > 12 then cast(v[1] as integer) else cast(v[2] as integer) end])
        || list_transform(named, lambda v: [cast(regexp_extract(v, '{x.NAMED_DATE}', 3) as integer), list_position({list(x.MONTHS)}, lower(substring(v, 1, 3))), cast(regexp_extract(v, '{x.NAMED_DATE}', 2) as integer)]) as parts from p)
    select kind, id, array_to_string(list_sort(list_distinct(list_filter(list_transform(parts, lambda v: cast(try_cast(printf('%04d-%02d-%02d', v[1], v[2], v[3]) as date) as varchar)), lambda v: v is not null))), ',') as dates,
    {_HINT} as document_type, {_COURT} as jurisdiction from k"""))
def extract_metadata(spark, d):
    return x.metadata(b.writings(spark, d)).withColumn("dates", F.array_join(F.transform("dates", lambda v: v.cast("string")), ","))


#: Names that facts may be about: letters' parties and addresses.
_PARTY = "[A-Z][a-z]+[0-9]+|[a-z0-9.]+@[a-z0-9.]+"


def _facts_sql(facts) -> str:
    """A list of (type, fact) of all patterns."""
    said = lambda p, n: f"regexp_extract_all(text, '{p}', 1)" if n == 1 else f"list_transform(list_zip(regexp_extract_all(text, '{p}', 1), regexp_extract_all(text, '{p}', 2)), lambda v: v[1] || ' ' || v[2])"
    return " || ".join(f"list_transform({said(*fact)}, lambda v: ['{k}', regexp_replace(v, '^\\s+|\\s+$', '', 'g')])" for k, fact in facts.items())


#: The tables' own kind of fact, beside the operator's.
_ALL_FACTS = x.FACTS | {"license": (r"(?i)licensed under ([^.\n]{3,80})", 1)}


@query("extract_key_facts", sql("writings", f""", f as (select kind, id, regexp_extract_all(text, '{_PARTY}') as entities, ({_facts_sql(_ALL_FACTS)})[1:10] as found from writings),
    p as (select kind, id, entities, unnest(found) as v, generate_subscripts(found, 1) - 1 as position from f)
    select kind, id, position, v[1] as fact_type, substring(v[2], 1, 500) as fact, array_to_string(list_filter(entities, lambda e: contains(lower(v[2]), lower(e)))[1:5], ',') as related from p"""))
def extract_key_facts(spark, d):
    rows = b.writings(spark, d).withColumn("entities", F.regexp_extract_all("text", F.lit(_PARTY), F.lit(0)))
    return x.key_facts(rows, _ALL_FACTS).withColumn("related", F.array_join("related", ","))


_CATEGORY = "case " + " ".join(f"when regexp_matches(lower(text), '{p}') then '{k}'" for k, p in x.CATEGORIES.items()) + " else 'document' end"


@query("categorize_text", f"select doc_id, {_CATEGORY} as category from documents")
def categorize_text(spark, d):
    return _docs(spark, d).select("doc_id", x.category(F.col("text")).alias("category"))


_KIND_OF = {"contract": "contract", "affidavit": "evidence", "exhibit": "evidence", "correspondence": "correspondence", "deposition": "discovery", "legal_filing": "pleading", "financial": "financial"}
_KEYWORDS = ", ".join(f"({i}, '{c}', [{', '.join(repr(k) for k in ks)}])" for i, (c, ks) in enumerate(x.KEYWORDS.items()))


@query("category_keyword_matches", sql("writings", f""", c as (select kind, id, lower(text) as low, case when length(text) % 3 = 0 then 0.9 else 0.6 end as confidence,
        case {_CATEGORY} {" ".join(f"when '{k}' then '{v}'" for k, v in _KIND_OF.items())} end as category from writings),
    k as (select * from (values {_KEYWORDS}) v(at_, suggested, words)),
    h as (select c.*, at_, suggested, list_slice(list_filter(words, lambda w: contains(low, w)), 1, 5) as hits from c, k where confidence < 0.8 and suggested is distinct from category)
    select kind, id, category, confidence, suggested, array_to_string(hits, ',') as keywords, row_number() over (partition by kind, id order by len(hits) desc, at_) as rank from h where len(hits) > 0"""))
def category_keyword_matches(spark, d):
    """Other categories for writings whose own one is not sure; two in three aren't (by their length)."""
    own = F.create_map(*[F.lit(x_) for pair in _KIND_OF.items() for x_ in pair])
    rows = b.writings(spark, d).select("kind", "id", "text", F.try_element_at(own, x.category(F.col("text"))).alias("category"), F.when(F.length("text") % 3 == 0, 0.9).otherwise(0.6).alias("confidence"))
    return x.other_categories(rows, ["kind", "id"])


@query("extraction_coverage_score", sql("mentions", """, n as (select document_id, count(*) as n, count(distinct entity_type) as types from mentions group by 1),
    s as (select doc_id, coalesce(n, 0) as n, coalesce(types, 0) as types, coalesce(length(text), 0) as size, greatest(1, ceil(coalesce(length(text), 0) / 3000.0)) as pages from documents left join n on document_id = doc_id)
    select doc_id as document_id, round(least(100.0, 50 + least(1, n / pages / 2.0) * 20 + least(1, types / 3.0) * 20 + case when size > 0 then least(1, n * 1000.0 / size / 5) * 10 else 0 end), 6) as score from s"""))
def extraction_coverage_score(spark, d):
    """From mentions per page, their types and their density; a page has 3,000 characters."""
    found = b.mentions(spark, d).groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n"), F.countDistinct("entity_type").alias("types"))
    docs = _docs(spark, d).select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    rows = docs.join(found, "doc_id", "left").na.fill(0, ["n", "types"])
    return rows.select(F.col("doc_id").alias("document_id"), q.coverage_score(F.col("n"), F.greatest(F.lit(1), F.ceil(F.col("size") / 3000)), F.col("size"), F.col("types")).alias("score"))


_FOUND = """, f as (select document_id, count(*) as n, count(distinct entity_type) as types, sum(confidence) * 1.0 / count(*) as avg_confidence, count(*) filter (where confidence < 70) as low,
    count(*) - count(distinct canonical_id) as repeated from scored group by 1),
    v as (select *, 50 + least(20, n) + least(20, 5 * types) + least(10, n // 10) as coverage from f)"""


@query("extraction_completeness", sql("scored", _FOUND + """ select document_id, n, types, avg_confidence, low, repeated, coverage, case when coverage >= 80 and avg_confidence >= 80 then 'excellent'
    when coverage >= 60 and avg_confidence >= 70 then 'good' when coverage >= 40 and avg_confidence >= 60 then 'fair' when coverage >= 20 or avg_confidence >= 50 then 'poor' else 'very_poor' end as label from v"""))
def extraction_completeness(spark, d):
    f = b.scored(spark, d).groupBy("document_id").agg(
        F.count("*").alias("n"), F.countDistinct("entity_type").alias("types"), (F.sum("confidence") / F.count("*")).alias("avg_confidence"), F.count_if(F.col("confidence") < 70).alias("low"),
        (F.count("*") - F.countDistinct("canonical_id")).alias("repeated"))
    coverage = 50 + F.least(F.lit(20), "n") + F.least(F.lit(20), 5 * F.col("types")) + F.least(F.lit(10), F.floor(F.col("n") / 10))
    v, sure = f.withColumn("coverage", coverage.cast("long")), F.col("avg_confidence")
    at = lambda c, k: (F.col("coverage") >= c) & (sure >= k)
    label = F.when(at(80, 80), "excellent").when(at(60, 70), "good").when(at(40, 60), "fair").when((F.col("coverage") >= 20) | (sure >= 50), "poor").otherwise("very_poor")
    return v.withColumn("label", label)


_FACT = [p for p, _ in _ALL_FACTS.values()]
_HAS_FACT = " or ".join(f"regexp_matches(text, '{p}')" for p in _FACT)


@query("extraction_completeness_score", sql("scored", f""", e as (select document_id, count(*) as entities, count(distinct canonical_id) as names from scored group by 1)
    select doc_id, case when {_HAS_FACT} then 0.3 else 0.0 end + case when coalesce(entities, 0) > 0 then 0.4 else 0.0 end
    + case when coalesce(names, 0) > 1 then 0.2 else 0.0 end + case when {_CATEGORY} <> 'document' then 0.1 else 0.0 end as score from documents left join e on document_id = doc_id"""))
def extraction_completeness_score(spark, d):
    """0.3 for facts, 0.4 for entities, 0.2 for relations (two entities that occur
    together) and 0.1 for a known type."""
    e = b.scored(spark, d).groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("entities"), F.countDistinct("canonical_id").alias("names"))
    rows = _docs(spark, d).join(e, "doc_id", "left")
    text = F.col("text")
    part = lambda on, value: F.when(on, value).otherwise(0.0)
    facts = reduce(lambda a, z: a | z, [text.rlike(p) for p in _FACT])
    score = part(facts, 0.3) + part(F.col("entities") > 0, 0.4) + part(F.col("names") > 1, 0.2) + part(x.category(text) != "document", 0.1)
    return rows.select("doc_id", score.alias("score"))


@query("resolution_accuracy", sql("scored", """, c as (select canonical_id, count(*) as n from scored where confidence >= 70 group by 1),
    t as (select lower(entity_text) as name, count(distinct entity_type) as types from scored group by 1), r as (select count(*) filter (where confidence >= 70) * 100.0 / count(*) as resolved, count(*) as mentions from scored),
    x as (select count(*) as clusters, count(*) filter (where n > 1) as shared, sum(n) * 1.0 / count(*) as avg_size from c), k as (select count(*) filter (where types > 1) as conflicts from t)
    select resolved, clusters, shared, avg_size, conflicts, least(100.0, greatest(0.0, resolved + least(10, 2 * shared) - conflicts * 50.0 / mentions)) as score from r, x, k"""))
def resolution_accuracy(spark, d):
    """Mentions of 70 or more confidence count as resolved; names of several types conflict."""
    s = b.scored(spark, d)
    sure = F.col("confidence") >= 70
    r = s.agg((F.count_if(sure) * 100.0 / F.count("*")).alias("resolved"), F.count("*").alias("mentions"))
    c_ = s.where(sure).groupBy("canonical_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("clusters"), F.count_if(F.col("n") > 1).alias("shared"), (F.sum("n") / F.count("*")).alias("avg_size"))
    k = s.groupBy(F.lower("entity_text")).agg(F.countDistinct("entity_type").alias("types")).agg(F.count_if(F.col("types") > 1).alias("conflicts"))
    score = F.col("resolved") + F.least(F.lit(10), 2 * F.col("shared")) - F.col("conflicts") * 50.0 / F.col("mentions")
    return r.join(F.broadcast(c_)).join(F.broadcast(k)).select(  # one row each
        "resolved", "clusters", "shared", "avg_size", "conflicts", F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)).alias("score"))


_CONSISTENT = """, c as (select document_id, count(*) as chunks, sum(length(chunk_text)) as size from chunks group by 1),
    e as (select s.document_id, count(*) as mentions, count(*) filter (where c.chunk_index is null) as lost, count(*) filter (where confidence >= 70) as resolved
        from scored s left join chunks c on c.document_id = s.document_id and c.chunk_index = s.chunk_index group by 1),
    r as (select doc_id, coalesce(length(text), 0) as size, c.size as chunk_size, coalesce(length(text), 0) > 0 as has_text, c.chunks is not null as has_chunks, e.mentions is not null as has_entities,
        coalesce(e.resolved, 0) > 0 as has_resolution, e.lost from documents d left join c on c.document_id = d.doc_id left join e on e.document_id = d.doc_id),
    k as (select *, case when has_text and has_chunks then abs(size - chunk_size) * 10 < size end as near, case when has_chunks and has_entities then lost = 0 end as placed, case when has_entities and has_resolution then true end as known from r),
    v as (select *, 12.5 * (cast(has_text as integer) + cast(has_chunks as integer) + cast(has_entities as integer) + cast(has_resolution as integer))
        + coalesce(50.0 * (coalesce(cast(near as integer), 0) + coalesce(cast(placed as integer), 0) + coalesce(cast(known as integer), 0))
        / nullif(cast(near is not null as integer) + cast(placed is not null as integer) + cast(known is not null as integer), 0), 0) as completeness,
        coalesce(near, placed, known) is not null and coalesce(near, true) and coalesce(placed, true) and coalesce(known, true) as consistent,
        array_to_string(list_filter([case when not has_text then 'no source_document' end, case when not has_chunks then 'no chunks' end, case when not has_entities then 'no entities' end, case when not has_resolution then 'no resolution' end,
        case when not near then 'source_to_chunks' end, case when not placed then 'chunks_to_entities' end, case when not known then 'entities_to_resolution' end], lambda i: i is not null), ';') as issues from k)"""


def _consistency(spark, d):
    """Mentions of 70 or more confidence count as resolved."""
    found = b.scored(spark, d)
    named = found.select("document_id", "chunk_index", F.concat_ws(":", "chunk_index", "entity_type", "ordinal").alias("mention"), "confidence")
    return q.consistency(_docs(spark, d).select("doc_id", "text"), b.chunks(spark, d), named, named.where("confidence >= 70"))


@query("data_consistency", sql("scored", _CONSISTENT + " select doc_id, consistent, completeness, issues from v"))
def data_consistency(spark, d):
    return _consistency(spark, d).select("doc_id", "consistent", "completeness", F.array_join("issues", ";").alias("issues"))


@query("e2e_validation", sql("tasks scored", _CONSISTENT + """, t as (select document_id, max_by(stage, event_id) as stage, max_by(status, event_id) as status, max_by(k, event_id) as minutes from tasks group by 1),
    j as (select doc_id, completeness, coalesce(status, 'unknown') as status, stage, coalesce(minutes, 0) as minutes from v left join t on t.document_id = doc_id),
    i as (select *, list_filter([case when status <> 'completed' then 'not completed: ' || status end, case when status = 'failed' then 'failed stages: ' || stage end,
    case when completeness < 85 then 'low consistency' end, case when minutes > 30 then 'took too long' end], lambda y: y is not null) as found from j)
    select doc_id, len(found) = 0 as passed, array_to_string(found, ';') as issues from i"""))
def e2e_validation(spark, d):
    """A document's status is that of its last task, whose key stands for its minutes."""
    last = lambda c: F.max_by(c, "event_id").alias(c)
    runs = b.tasks(spark, d).groupBy(F.col("document_id").alias("doc_id")).agg(last("stage"), last("status"), last("k"))
    rows = q.validate_flow(_consistency(spark, d), runs.withColumnRenamed("k", "minutes"))
    return rows.select("doc_id", "passed", F.array_join("issues", ";").alias("issues"))


@query("document_fitness", sql("scored", _CONSISTENT + """ select case when completeness > 95 then 'EXCELLENT' when completeness > 80 then 'GOOD' when completeness > 60 then 'FAIR' else 'POOR' end as fitness,
    count(*) as documents from v group by 1"""))
def document_fitness(spark, d):
    level = F.when(F.col("completeness") > 95, "EXCELLENT").when(F.col("completeness") > 80, "GOOD").when(F.col("completeness") > 60, "FAIR").otherwise("POOR")
    return _consistency(spark, d).groupBy(level.alias("fitness")).agg(F.count("*").alias("documents"))


@query("stage_completion_rates", sql("tasks", """, p as (select stage, count(distinct document_id) filter (where status = 'completed') * 100.0 / (select count(distinct document_id) from tasks) as percent from tasks group by 1)
    select stage, percent, percent < 80 as bottleneck from p"""))
def stage_completion_rates(spark, d):
    tasks = b.tasks(spark, d)
    total = tasks.agg(F.countDistinct("document_id").alias("total"))
    done = tasks.groupBy("stage").agg(F.countDistinct(F.when(F.col("status") == "completed", F.col("document_id"))).alias("n"))
    rows = done.join(F.broadcast(total)).select("stage", (F.col("n") * 100.0 / F.col("total")).alias("percent"))  # one row
    return rows.withColumn("bottleneck", F.col("percent") < 80)


@query("throughput_rating", sql("tasks", """, h as (select date_trunc('hour', ts) as hour, count(distinct document_id) as n from tasks where status = 'completed' group by 1)
    select hour, n, case when n >= 15 then 'excellent' when n >= 11 then 'good' when n >= 8 then 'fair' when n >= 4 then 'slow' else 'critical' end as rating from h"""))
def throughput_rating(spark, d):
    h = b.tasks(spark, d).where("status = 'completed'").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.countDistinct("document_id").alias("n"))
    n = F.col("n")
    return h.withColumn("rating", F.when(n >= 15, "excellent").when(n >= 11, "good").when(n >= 8, "fair").when(n >= 4, "slow").otherwise("critical"))


@query("assemble_parts", sql("turns", """select document_id, count(*) as parts, sum(1 + length(text) % 4) as pages, md5(string_agg(text, chr(10) || chr(10) order by chunk_index)) as digest from turns group by 1
    having max(chunk_index) - min(chunk_index) = count(*) - 1 and bool_and(length(text) % 11 <> 0)"""))
def assemble_parts(spark, d):
    """Conversations put together from their turns; a turn's length tells its pages and whether it failed."""
    size = F.length("text")
    return x.assemble_parts(b.turns(spark, d).withColumn("pages", 1 + size % 4).withColumn("status", F.when(size % 11 == 0, "failed").otherwise("completed")))


@query("combine_segments", sql("turns", """, s as (select document_id, ['page', 'image', 'audio'][chunk_index % 3 + 1] as family, chunk_index, case when chunk_index % 6 = 4 then null else text end as text, 70 + length(text) % 30 as confidence from turns),
    f as (select document_id, string_agg(text, chr(10) || chr(10) order by chunk_index) filter (where family = 'page' and text <> '') as p, string_agg(text, chr(10) || chr(10) order by chunk_index) filter (where family = 'image' and text <> '') as i,
    string_agg(text, ' ' order by chunk_index) filter (where family = 'audio' and text <> '') as a, count(*) filter (where family = 'page') as pages, count(*) filter (where family = 'image') as images, count(*) filter (where family = 'audio') as audios,
    avg(confidence) filter (where family = 'page') as page_confidence from s group by 1)
    select document_id, md5(concat_ws(chr(10) || chr(10), p, i, a)) as digest, pages, images, audios, page_confidence from f"""))
def combine_segments(spark, d):
    """Turns as pages, images (every second without text) and speech."""
    at = F.col("chunk_index")
    family = F.element_at(F.array(*map(F.lit, x.FAMILIES)), (at % 3 + 1).cast("int"))
    rows = b.turns(spark, d).select("document_id", family.alias("family"), at.alias("place"), F.when(at % 6 != 4, F.col("text")).alias("text"), (70 + F.length("text") % 30).alias("confidence"))
    return x.combine_segments(rows).select("document_id", F.md5("text").alias("digest"), "pages", "images", "audios", "page_confidence")


@query("ocr_blocks_to_text")
def ocr_blocks_to_text(spark, d):
    """Conversation turns as the lines of pages: the turn's order is the page's."""
    lines = b.turns(spark, d).select("document_id", (F.floor(F.col("chunk_index") / 2) + 1).cast("int").alias("page"), F.struct(
        (F.col("chunk_index") % 2).cast("double").alias("top"), F.lit(0.0).alias("left"), "text").alias("line"), (90 - F.length("text") % 20).alias("confidence"))
    return x.blocks_to_text(lines).select("document_id", "pages", F.md5("text").alias("digest"))


@query("ocr_confidence", sql("turns", "select document_id, sum(90 - length(text) % 20) / count(*) as confidence from turns group by 1"))
def ocr_confidence(spark, d):
    return b.turns(spark, d).groupBy("document_id").agg((F.sum(90 - F.length("text") % 20) / F.count("*")).alias("confidence"))
