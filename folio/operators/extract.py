"""Extraction from text: chunks by structure, entities, facts, quality marks."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as t
from folio.operators.chunking import chunk_fixed
from folio.sources.storage import written


#: Patterns of legal elements, by kind.
ELEMENTS = {
    "citations": (
        r"\d+\s+[A-Z][a-z]+\.?\s*\d+d?\s+\d+(?:\s*\([^)]+\))?",
        r"\d+\s+U\.S\.C\.\s*§\s*\d+\w*",
        r"Fed\.\s*R\.\s*[A-Z][a-z]+\.\s*P\.\s*\d+(?:\([a-z]\))?",
        r"[A-Z][a-z]+\s+v\.\s+[A-Z][a-z]+(?:,\s*\d+\s+[A-Z][a-z]+\.?\s*\d+)?",
    ),
    "dates": (
        r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
        r"\b\d{1,2}-\d{1,2}-\d{2,4}\b",
        r"(?i)\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}\b",
        r"(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\.?\s+\d{1,2},?\s+\d{4}\b",
    ),
    "money": (r"(?i)\$[\d,]+(?:\.\d{2})?", r"(?i)\b\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:dollars?|USD)\b"),
    "sections": (r"(?i)(?:Section|Sec\.|§)\s*\d+(?:\.\d+)*", r"(?i)(?:Article|Art\.)\s*\d+", r"(?i)(?:Paragraph|Para\.)\s*\d+", r"(?i)Clause\s*\d+(?:\.\d+)*"),
    "parties": (r"(?:Plaintiff|Defendant|Petitioner|Respondent|Appellant|Appellee),?\s+[A-Z][a-zA-Z\s]+?(?:,|\s+(?:moves|respectfully|hereby))",),
}
#: Words whose share counts as legal density.
LEGAL_TERMS = ("whereas", "therefore", "hereby", "pursuant", "notwithstanding", "herein", "thereof", "hereunder", "foregoing")
WORD = r"[^ \t\n\r\f\x0B]+"


def enrich_chunks(chunks: DataFrame) -> DataFrame:
    """Counts of legal elements, words and sentences, a density from 0 to 1 (by
    citations and dates in a hundred words, sentence length and legal terms),
    and the chunk's id."""
    text = F.col("chunk_text")
    count = lambda patterns: sum((F.regexp_count(text, F.lit(p)) for p in patterns[1:]), F.regexp_count(text, F.lit(patterns[0])))
    rows = chunks.select(
        "document_id", "chunk_index", *[count(patterns).alias(kind) for kind, patterns in ELEMENTS.items()],
        F.regexp_count(text, F.lit(WORD)).alias("words"), F.regexp_count(text, F.lit("[.!?]")).alias("sentences"),
        F.size(F.filter(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w).isin(*LEGAL_TERMS))).alias("terms"))
    words, size = F.col("words"), F.greatest("words", F.lit(1))
    length = F.when(F.col("sentences") > 0, words / F.greatest("sentences", F.lit(1))).otherwise(words)
    density = F.col("citations") * 100 / size * 0.3 + F.col("dates") * 100 / size * 0.1 + F.when(length > 15, 1.0).otherwise(0.5) * 0.3 + F.col("terms") / size * 0.3
    chunk_id = F.format_string("doc%d_chunk_%04d", "document_id", "chunk_index")
    return rows.withColumn("density", F.least(F.lit(1.0), density)).withColumn("chunk_id", chunk_id).drop("terms")


#: Words in a line that tell a document's type.
LINE_TYPES = {"MOTION": "motion", "COMPLAINT": "complaint", "MEMORANDUM": "memorandum", "AFFIDAVIT": "affidavit", "CONTRACT": "contract", "AGREEMENT": "contract"}
PAGE_END = "<END_OF_PAGE>"


def document_structure(docs: DataFrame, first: int = 100) -> DataFrame:
    """Kinds of numbered lines and the likely type among the first lines (the
    last line that tells one decides), pages, lines, words and tokens."""
    text = F.col("text")
    lines = F.transform(F.slice(F.split(text, "\n"), 1, first), t.strip)
    has = lambda p: F.exists(lines, lambda v: v.rlike(p))
    kind = lambda v: F.coalesce(*[F.when(F.upper(v).contains(word), name) for word, name in LINE_TYPES.items()])
    kinds = F.array_compact(F.transform(lines, kind))
    return docs.select(
        "doc_id", F.size(F.split(text, "\n")).alias("lines"), F.regexp_count(text, F.lit(r"[^ \t\n]+")).alias("words"), F.floor(F.length(text) / 4).alias("tokens"),
        has(r"^\d+\.\s+").alias("numbered"), has(r"^[IVX]+\.\s+").alias("roman"), has(r"^[a-z]\.\s+").alias("lettered"),
        (F.regexp_count(text, F.lit(PAGE_END)) + 1).alias("pages"), F.coalesce(F.try_element_at(kinds, F.lit(-1)), F.lit("unknown")).alias("likely_type"))


def merge_small(parts: Column, least: int = 100) -> Column:
    """Parts joined forward by a blank line until each has `least` characters."""
    begin = F.struct(F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(state: Column, part: Column) -> Column:
        joined = F.when(F.length(state["open"]) > 0, F.concat(state["open"], F.lit("\n\n"), part)).otherwise(part)
        full = F.length(joined) >= least
        return F.struct(F.when(full, "").otherwise(joined).alias("open"), F.when(full, F.concat(state["done"], F.array(joined))).otherwise(state["done"]).alias("done"))

    return F.aggregate(parts, begin, step, lambda s: F.when(F.length(s["open"]) > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def chunk_markdown(docs: DataFrame, least: int = 100, guide: str = "guide") -> DataFrame:
    """Sections of a markdown guide, located in the raw text from left to right.

    Sections split at headings and blank lines; those not found are left out.
    """
    sections = F.filter(F.transform(F.split(F.col(guide), r"\n(?=#)|\n\s*\n"), lambda s: t.strip(F.regexp_replace(s, r"^#{1,6}\s+", ""))), lambda s: F.length(s) > 0)
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<chunk_text:string,char_start:int,char_end:int>>").alias("found"))

    def step(state: Column, section: Column) -> Column:
        place = F.call_function("locate", section, F.col("text"), state["at"])
        one = F.struct(section.alias("chunk_text"), (place - 1).alias("char_start"), (place - 1 + F.length(section)).alias("char_end"))
        return F.when(place > 0, F.struct((place + F.length(section)).alias("at"), F.concat(state["found"], F.array(one)).alias("found"))).otherwise(state)

    found = F.aggregate(sections, begin, step, lambda s: s["found"])
    return docs.select("doc_id", F.posexplode(found).alias("chunk_index", "c")).select("doc_id", "chunk_index", "c.*").where(F.length("chunk_text") >= F.lit(1))


def chunk_fallback(docs: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Line sections of several hundred characters where a text has them, else
    fixed windows; `method` tells which."""
    lines = F.split("text", "\n")
    parts = docs.where(F.size(lines) >= 3).select("doc_id", F.posexplode(merge_small(lines, 300)).alias("chunk_index", "chunk_text"))
    fixed = chunk_fixed(docs.where(F.size(lines) < 3).select("doc_id", "text"), size, overlap).select("doc_id", "chunk_index", "chunk_text")
    return parts.withColumn("method", F.lit("sections")).unionByName(fixed.withColumn("method", F.lit("fixed")))


#: How a section's first line (stripped) looks, the first that fits.
SECTIONS = (
    ("roman_section", r"^[IVX]+\.\s+[A-Z][A-Z\s]+$"),
    ("numbered_section", r"^\d+\.\s+[A-Z][A-Z\s]+$"),
    ("colon_section", r"^[A-Z][A-Z\s]+:$"),
    ("caps_heading", r"^[A-Z][A-Z\s]{10,}$"),
    ("page_break", r"^\s*\[PAGE BREAK\]\s*$"),
    ("letter_subsection", r"^[a-z]\.\s+"),
    ("paren_subsection", r"^\(\d+\)\s+"),
    ("bullet_point", r"^-\s+"),
    ("contract_section", r"^(Section|Article|Clause)\s+\d+(\.\d+)*"),
    ("contract_section_caps", r"^(SECTION|ARTICLE|CLAUSE)\s+\d+(\.\d+)*"),
    ("signature_block", r"^(SIGNED|EXECUTED|WITNESS)"),
    ("signature_line", r"^_{10,}"),
    ("signature_by", r"^By:\s*_{5,}"),
    ("signature_date", r"^(Date|Dated):\s*_{5,}"),
)
#: Sections that open a chunk, lines of signatures, citations that stay whole.
MAJOR = ("roman_section", "numbered_section", "caps_heading", "page_break", "contract_section", "contract_section_caps")
SIGNATURES = (r"^_{10,}", r"^By:\s*_{5,}", r"^Name:\s*", r"^Title:\s*", r"^Date:\s*", r"^WITNESS", r"^NOTARY", r"^Respectfully submitted", r"^Sincerely", r"^\s*/s/")
CITATIONS = (r"\d+\s+[A-Z][a-z]+\.?\s*\d+d?\s+\d+", r"\d+\s+U\.S\.C\.\s*§\s*\d+", r"Fed\.\s*R\.\s*[A-Z][a-z]+\.\s*P\.\s*\d+", r"[A-Z][a-z]+\s+v\.\s+[A-Z][a-z]+", r"\d+\s+[A-Z]\.\s*Supp\.\s*\d+d?\s+\d+")
_SECTION = [(kind, re.compile(p)) for kind, p in SECTIONS]
_SIGNED = re.compile("|".join(SIGNATURES), re.IGNORECASE)
_CITED = re.compile("|".join(CITATIONS))
_NUMBERED = re.compile(r"^(\d+)\.\s+")
_SUB_ITEM = re.compile(r"^\s+(?:[a-z]\.|\(\d+\))\s+")
_LISTED = re.compile(r"^\d+\.")


def _line_kinds(lines: list[str]) -> list[str | None]:
    """What section each line opens; an empty line behind a full one ends a paragraph."""
    kinds = []
    for before, line in zip(["", *lines], map(str.strip, lines)):
        kind = next((k for k, p in _SECTION if p.match(line)), None)
        kinds.append("paragraph_break" if not line and before.strip() else kind)
    return kinds


def _in_lists(lines: list[str]) -> list[bool]:
    """Whether each line goes on with a numbered list."""
    inside, out = False, []
    for before, line in zip(["", *lines], lines):
        was, now = _NUMBERED.match(before.strip()), _NUMBERED.match(line.strip())
        if was and (int(now[1]) == int(was[1]) + 1 if now else _SUB_ITEM.match(line)):
            inside = True
        elif not _LISTED.match(line.strip()):
            inside = False
        out.append(inside)
    return out


def _semantic(text: str, least: int, most: int) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, lines) of runs of lines.

    A major section opens a chunk once there are `least` characters, each line of
    a signature block stands alone, and from `most` characters on a chunk ends at
    the next section or paragraph, or here if none is near; numbered lists and
    citations hold a chunk together.  A short chunk is joined to the next one
    (once) up to half as much again as `most`.
    """
    lines = text.split("\n")
    starts = [0, *itertools.accumulate(len(line) + 1 for line in lines)]
    kinds, listed = _line_kinds(lines), _in_lists(lines)
    out, first, kind, signing = [], 0, "content", False
    for i, line in enumerate(lines):
        size, signed = starts[i] - starts[first], bool(_SIGNED.match(line.strip()))
        signing |= signed
        split = signing or (kinds[i] in MAJOR and size >= least and not listed[i])
        if not split and size >= most and not listed[i] and not _CITED.search(text, starts[max(first, i - 3)], starts[i + 1] - 1):
            ahead = range(i + 1, min(i + 10, len(lines)))
            split = bool(kinds[i]) or (i + 1 < len(lines) and not any(kinds[j] and starts[j] - starts[first] <= most + 200 for j in ahead))
        if split and i > first:
            out.append((starts[first], starts[i] - 1, "signature_block" if signing else kind, i - first))
            first, kind = i, kinds[i] or "content"
            signing &= signed
    out.append((starts[first], len(text), kind, len(lines) - first))
    merged, i = [], 0
    while i < len(out):
        (a, z, *rest), after = out[i], out[i + 1 : i + 2]
        if z - a < least and after and after[0][1] - a <= 1.5 * most:
            merged.append((a, after[0][1], "merged", rest[1] + after[0][3]))
            i += 2
        else:
            merged.append(out[i])
            i += 1
    return merged


def chunk_semantic(docs: DataFrame, least: int = 300, most: int = 1500, beyond: int = 50) -> DataFrame:
    """Chunks along sections, lists and signature blocks of each document's lines.

    docs has doc_id and text; page ends become lines of their own, and places
    count in the text with these.  overlap is what follows, up to `beyond`
    characters; empty texts have no chunks.  A small line machine runs on whole
    documents; the table itself is not shuffled.
    """
    def work(batches):
        columns = ["doc_id", "chunk_index", "chunk_text", "char_start", "char_end", "kind", "line_count", "overlap"]
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                text = (text or "").replace(PAGE_END, "\n\n[PAGE BREAK]\n\n")
                pieces = _semantic(text, least, most) if text else []
                rows += [(doc, i, text[a:z], a, z, kind, n, text[z + 1 : z + 1 + beyond]) for i, (a, z, kind, n) in enumerate(pieces)]
            yield pdf.__class__(rows, columns=columns)

    cut = docs.mapInPandas(work, "doc_id long, chunk_index int, chunk_text string, char_start int, char_end int, kind string, line_count int, overlap string")
    lines = F.transform(F.split("chunk_text", "\n"), t.strip)
    return cut.withColumns({
        "has_citations": F.col("chunk_text").rlike("|".join(CITATIONS)), "has_list": F.exists(lines, lambda v: v.rlike(r"^\d+\.")),
        "has_signature": F.exists(lines, lambda v: v.rlike("(?i)" + "|".join(SIGNATURES)))})


#: Rule patterns, by type, with their confidence.
RULES = {
    "DATE": (r"(?i)\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}\b", 0.8),
    "MONEY": (r"\$[\d,]+(?:\.\d{2})?", 0.9),
    "STATUTE": (r"\b\d+\s+U\.S\.C\.\s*§\s*\d+\b", 0.95),
    "EMAIL": (r"[a-z0-9.]+@[a-z0-9.]+", 0.9),
    "ADDRESS": (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", 0.9),
}


def rule_entities(chunks: DataFrame, rules: dict = RULES) -> DataFrame:
    """Mentions by pattern with their place in chunk_text; other columns are kept."""
    def of(kind: str, pattern: str, confidence: float) -> Column:
        named = lambda v: F.struct(
            F.lit(kind).alias("entity_type"), v["match"].alias("entity_text"), v["start"].alias("start"), v["stop"].alias("stop"), F.lit(confidence).alias("confidence"))
        return F.transform(t.find_all(F.col("chunk_text"), pattern), named)

    kinds = [of(kind, *rule) for kind, rule in rules.items()]
    return chunks.select(*[c for c in chunks.columns if c != "chunk_text"], F.inline(F.concat(*kinds)))


def proper_nouns(chunks: DataFrame, first: int = 10, most: int = 20) -> DataFrame:
    """document_id, nouns: the first `most` different names in the first chunks.

    A name is a capitalised word of more than two letters; one that follows a
    capitalised word is added to the name before it, if there is one.
    """
    words = F.regexp_extract_all("chunk_text", F.lit(WORD), F.lit(0))
    upper = lambda w: w.rlike(r"^\p{Lu}")
    begin = F.struct(F.array().cast("array<string>").alias("names"), F.lit(False).alias("after"))

    def step(state: Column, word: Column) -> Column:
        names, n = state["names"], F.size(state["names"])
        last = F.concat_ws(" ", F.try_element_at(names, F.lit(-1)), word)
        joined = F.concat(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(last))
        grown = F.when(state["after"] & (n > 0), joined).otherwise(F.concat(names, F.array(word)))
        return F.struct(F.when(upper(word) & (F.length(word) > 2), grown).otherwise(names).alias("names"), upper(word).alias("after"))

    # an empty word before each chunk, so that no name runs over from the one before
    rows = chunks.where(F.col("chunk_index") < first).select("document_id", "chunk_index", F.concat(F.array(F.lit("")), words).alias("words"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "words"))), lambda v: v["words"])
    whole = rows.groupBy("document_id").agg(F.flatten(ordered).alias("words"))
    names = F.aggregate("words", begin, step, lambda s: s["names"])
    return whole.select("document_id", F.slice(F.array_distinct(names), 1, most).alias("nouns"))


#: Categories, the first whose pattern a lower-cased text holds.
CATEGORIES = {
    "contract": r"\bagreement\b|\bcontract\b|\bparties\b.*\bagree\b",
    "affidavit": r"\baffidavit\b|\bsworn\b.*\bstatement\b|\bnotary\b",
    "correspondence": r"\bletter\b|\bcorrespondence\b|\bear\s+sir\b|\bdear\s+madam\b",
    "exhibit": r"\bexhibit\b|\bannex\b|\battachment\b",
    "deposition": r"\bdeposition\b|\btestimony\b|\bwitness\b",
    "legal_filing": r"\bmotion\b|\bplaintiff\b|\bdefendant\b|\bcourt\b",
    "financial": r"\binvoice\b|\bpayment\b|\bamount\b|\btotal\b",
}


def category(text: Column) -> Column:
    return F.coalesce(*[F.when(F.lower(text).rlike(p), name) for name, p in CATEGORIES.items()], F.lit("document"))


#: Keywords by kind of document.
KEYWORDS = {
    "pleading": (
        "complaint", "answer", "motion", "brief", "petition", "counterclaim", "cross-claim", "third-party complaint", "motion to dismiss",
        "motion for summary judgment"),
    "discovery": (
        "interrogatories", "deposition", "request for production", "request for admission", "subpoena", "notice of deposition",
        "discovery responses", "privilege log", "protective order"),
    "evidence": (
        "exhibit", "affidavit", "declaration", "witness statement", "expert report", "deposition transcript", "trial exhibit",
        "demonstrative evidence", "chain of custody"),
    "correspondence": (
        "letter", "email", "memorandum", "notice", "demand letter", "settlement communication", "meet and confer", "status update",
        "client communication", "opposing counsel letter"),
    "financial": (
        "invoice", "receipt", "statement", "tax return", "budget", "financial report", "expense report", "billing statement", "cost analysis",
        "damages calculation"),
    "contract": (
        "agreement", "contract", "amendment", "addendum", "lease", "purchase agreement", "service agreement", "nda", "licensing agreement",
        "settlement agreement"),
    "regulatory": (
        "regulatory filing", "compliance report", "permit", "license application", "regulatory notice", "inspection report",
        "administrative order", "agency correspondence"),
}


def keyword_hits(rows: DataFrame, keys: list[str], keywords: dict = KEYWORDS) -> DataFrame:
    """(*keys, category, keyword, place): the keywords that stand anywhere in the
    lower-cased text of rows(*keys, text), with their place in the category's list.

    An index of tokens is joined in place of a scan of each text for each keyword:
    of each distinct token is told, once, which keywords' longest words it holds.
    A keyword of one word is found by that; a text whose tokens hold the longest
    word of a longer one is looked at for the whole of it.
    """
    spark = rows.sparkSession
    listed = [(c, k, i, max(k.split(" "), key=len)) for c, ks in keywords.items() for i, k in enumerate(ks)]
    words = F.broadcast(spark.createDataFrame(listed, "category string, keyword string, place int, word string"))  # a fixed list
    low = rows.select(*keys, F.lower("text").alias("text"))
    tokens = low.select(*keys, F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("token"))
    index = written(tokens.select("token").distinct().join(words, F.col("token").contains(F.col("word"))).select("token", "category", "keyword", "place"), "keyword-index")
    found = tokens.join(index, "token").drop("token").distinct()
    whole = F.instr("keyword", " ") == 0
    longer = low.join(found.where(~whole), keys).where(F.col("text").contains(F.col("keyword"))).select(*keys, "category", "keyword", "place")
    return found.where(whole).unionByName(longer)


def other_categories(rows: DataFrame, keys: list[str], keywords: dict = KEYWORDS, sure: float = 0.8, most: int = 5) -> DataFrame:
    """For rows(*keys, text, category, confidence) less confident than `sure`: the
    other categories whose keywords stand in the text, the first `most` of these,
    and the category's rank by their number (then in the categories' order)."""
    unsure = rows.where(F.col("confidence") < sure)
    hits = keyword_hits(unsure, keys, keywords).withColumnRenamed("category", "suggested")
    hits = hits.join(unsure.select(*keys, "category", "confidence"), keys).where(~F.col("suggested").eqNullSafe(F.col("category")))
    few = F.slice(F.array_sort(F.collect_list(F.struct("place", "keyword"))), 1, most)  # of as many as a category has
    found = hits.groupBy(*keys, "category", "confidence", "suggested").agg(few.alias("few"))
    at = F.array_position(F.array(*map(F.lit, keywords)), F.col("suggested"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(F.size("few")), at)).cast("long")  # of as many as there are categories
    return found.select(*keys, "category", "confidence", "suggested", F.array_join(F.transform("few", lambda x: x["keyword"]), ",").alias("keywords"), rank.alias("rank"))


#: Fact patterns with their groups, in this order.
FACTS = {
    "allegation": (r"(?is)(plaintiff|petitioner)\s+alleges?\s+that\s+(.+?)(?:\.|;|,\s+and)", 2),
    "amount": (r"(?is)amount\s+of\s+\$?([\d,]+\.?\d*)", 1),
    "event": (r"(?is)on\s+or\s+about\s+(.+?),?\s+(.+?)(?:\.|;|,)", 2),
    "legal_basis": (r"(?is)pursuant\s+to\s+(.+?)(?:\.|;|,)", 1),
}


def key_facts(rows: DataFrame, facts: dict = FACTS, most: int = 10, related: int = 5) -> DataFrame:
    """At most `most` stated facts of a text, in the order of the patterns, with
    the first `related` of the row's entities that a fact names.

    rows has text and entities (an array of names); its other columns are kept.
    """
    def of(kind: str, pattern: str, groups: int) -> Column:
        found = [F.regexp_extract_all("text", F.lit(pattern), F.lit(g)) for g in range(1, groups + 1)]
        said = found[0] if groups == 1 else F.zip_with(found[0], found[1], lambda a, z: F.concat_ws(" ", a, z))
        return F.transform(said, lambda v: F.struct(F.lit(kind).alias("fact_type"), t.strip(v).alias("fact")))

    named = lambda fact: F.filter("entities", lambda e: F.lower(fact).contains(F.lower(e)))
    found = F.slice(F.concat(*[of(kind, *fact) for kind, fact in facts.items()]), 1, most)
    rest = [c for c in rows.columns if c not in ("text", "entities")]
    out = rows.select(*rest, "entities", F.posexplode(found).alias("position", "f"))
    return out.select(*rest, "position", "f.fact_type", F.substring("f.fact", 1, 500).alias("fact"), F.slice(named(F.col("f.fact")), 1, related).alias("related"))


#: Words that hint at a document's type, and patterns of jurisdictions, in order.
TYPE_HINTS = {
    "contract": ("agreement", "contract", "terms", "conditions"),
    "complaint": ("complaint", "plaintiff", "defendant", "alleges"),
    "motion": ("motion", "move", "request", "order"),
    "letter": ("dear", "sincerely", "regards", "letter"),
}
JURISDICTIONS = (r"(?i)(United States District Court)", r"(?i)(State of \w+)", r"(?i)(County of \w+)", r"(?i)(\w+ Circuit)")
NUMERIC_DATE = r"\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"
NAMED_DATE = r"(?i)(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{1,2}),?\s+(\d{4})"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def dates_in(text: Column) -> Column:
    """Sorted different dates of a text: month first unless that is over 12, and
    two-digit years from 1969 to 2068."""
    def date(y: Column, m: Column, d: Column) -> Column:
        return F.format_string("%04d-%02d-%02d", y, m, d).try_cast("date")

    def numeric(v: Column) -> Column:
        part = F.split(v, "[-/]")
        a, b, y = (part[i].cast("int") for i in range(3))
        year = F.when(F.length(part[2]) == 4, y).when(F.length(part[2]) == 2, y + F.when(y < 69, 2000).otherwise(1900))
        return F.when(year.isNotNull(), date(year, F.when(a > 12, b).otherwise(a), F.when(a > 12, a).otherwise(b)))

    def named(v: Column) -> Column:
        group = lambda i: F.regexp_extract(v, NAMED_DATE, i)
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(group(1), 1, 3)))
        return date(group(3).cast("int"), month, group(2).cast("int"))

    every = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.transform(every(NUMERIC_DATE), numeric), F.transform(every(NAMED_DATE), named)))))


def metadata(rows: DataFrame) -> DataFrame:
    """rows with the dates, the type hint and the jurisdiction of their text."""
    text, low = F.col("text"), F.lower("text")
    hint = F.coalesce(*[F.when(low.rlike("|".join(words)), kind) for kind, words in TYPE_HINTS.items()])
    court = F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in JURISDICTIONS])
    return rows.withColumns({"dates": dates_in(text), "document_type": hint, "jurisdiction": court}).drop("text")


#: What the fallback looks for.
FALLBACK = {"dates": r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b", "amounts": r"\$[\d,]+\.?\d*", "case_numbers": r"\b\d{2,}-\w+-\d{4,}\b|\bCase No\.\s*\d+\b"}


def fallback_structured(rows: DataFrame) -> DataFrame:
    """rows with dates, amounts and case numbers of their text (arrays, in order),
    the first date and case number, and the number of capitalised words."""
    every = lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
    names = F.filter(every(WORD), lambda w: w.rlike(r"^\p{Lu}") & (F.length(w) > 2))
    found = rows.withColumns({k: every(p) for k, p in FALLBACK.items()} | {"names": F.size(names)}).drop("text")
    return found.withColumns({"date": F.get("dates", F.lit(0)), "case_number": F.get("case_numbers", F.lit(0))})


#: Anomalies of recognised texts and their severity.
SEVERITY = {
    "empty": "critical", "short": "high", "low_confidence": "high", "medium_confidence": "medium", "repeated": "medium",
    "non_printable": "medium", "long_lines": "low", "few_letters": "medium",
}
LEAST_CONFIDENCE, LEAST_TEXT, MOST_ANOMALIES = 70, 50, 3


def text_anomalies(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, confidence, scanned) with size and anomalies: what
    looks wrong with a recognised text, by name and severity."""
    text, n, solid = F.col("text"), F.length("text"), F.length(t.strip(F.col("text")))
    lines = F.split(text, "\n")
    count = lambda p: F.regexp_count(text, F.lit(p))
    sure = F.col("confidence")
    marks = {
        "empty": solid == 0,
        "short": (solid > 0) & (solid < LEAST_TEXT),
        "low_confidence": sure < 50,
        "medium_confidence": (sure >= 50) & (sure < LEAST_CONFIDENCE),
        "repeated": text.rlike(r"([^\n])\1{5,}"),
        "non_printable": count(r"[^\x20-\x7E\n\r\t]") * 20 > n,
        "long_lines": F.size(F.filter(lines, lambda v: F.length(v) > 500)) * 10 > F.size(lines),
        "few_letters": count(r"\p{L}") * 10 < 3 * n,
    }
    found = F.array(*[F.when(mark, F.struct(F.lit(k).alias("name"), F.lit(SEVERITY[k]).alias("severity"))) for k, mark in marks.items()])
    return docs.select("doc_id", "confidence", "scanned", n.alias("size"), F.array_compact(found).alias("anomalies"))


def quality_scores(marked: DataFrame) -> DataFrame:
    """Score from 0 to 100, whether the text passes, and advice."""
    n, size, sure = F.size("anomalies"), F.col("size"), F.col("confidence")
    brief = F.when(size < LEAST_TEXT, 30).when(size < 200, 15).otherwise(0)
    doubt = F.when(sure < 50, 40).when(sure < LEAST_CONFIDENCE, 20).when(sure < 90, 10).otherwise(0)
    score = 100 - brief - doubt - 10 * n - F.when(F.col("scanned"), 5).otherwise(0)
    grave = F.exists("anomalies", lambda a: a["severity"].isin("high", "critical"))
    advice = F.array_compact(F.array(
        F.when(size < LEAST_TEXT, "verify the content"), F.when(sure < LEAST_CONFIDENCE, "try another method"), F.when(grave, "review by hand"),
        F.when(F.col("scanned") & (sure < 80), "enhance the image"), F.when(n > MOST_ANOMALIES, "review the process")))
    passed = ~F.array_contains(F.transform("anomalies", lambda a: a["name"]), "empty") & (sure >= LEAST_CONFIDENCE) & (size >= LEAST_TEXT) & ~grave
    return marked.withColumns({
        "score": F.least(F.lit(100), F.greatest(F.lit(0), score)), "passed": passed, "advice": F.when(F.size(advice) > 0, advice).otherwise(F.array(F.lit("successful")))})


def semantic_names(files: DataFrame) -> DataFrame:
    """File names from a template of host and id; generic ones are marked down."""
    safe = t.sanitize_filename(F.col("path"))
    rows = files.select("file_id", safe.alias("safe"), F.concat_ws("_", t.clean_component(F.col("host")), F.col("file_id").cast("string")).alias("name"))
    generic = F.col("safe").contains("utm") | F.col("safe").contains("page")
    return rows.select("file_id", "safe", "name", generic.alias("generic"), F.when(generic, 0.45).otherwise(0.9).alias("confidence"))


def assemble_parts(parts: DataFrame, separator: str = "\n\n") -> DataFrame:
    """Texts of documents all of whose parts are completed, in part order, and the
    sum of their pages.

    parts has document_id, chunk_index, text, status, pages; a document whose
    parts' numbers have gaps isn't complete.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda v: v["text"])
    done = F.bool_and(F.col("status") == "completed") & (F.max("chunk_index") - F.min("chunk_index") == F.count("*") - 1)
    rows = parts.groupBy("document_id").agg(
        F.count("*").alias("parts"), F.sum("pages").alias("pages"), done.alias("done"), F.md5(F.array_join(ordered, separator)).alias("digest"))
    return rows.where("done").drop("done")


#: Families of segments in the order of a document's text, and what joins a family's.
FAMILIES = {"page": "\n\n", "image": "\n\n", "audio": " "}


def combine_segments(segments: DataFrame) -> DataFrame:
    """Each document's pages, texts found in images and spoken segments as one
    text, with the number of each and the mean confidence of the pages.

    segments has document_id, family, place, text, confidence; segments without
    text count but join nothing.
    """
    filled = F.col("text").isNotNull() & (F.col("text") != "")
    of = lambda f: F.array_sort(F.collect_list(F.when((F.col("family") == f) & filled, F.struct("place", "text"))))
    rows = segments.groupBy("document_id").agg(
        *[of(f).alias(f) for f in FAMILIES], *[F.count_if(F.col("family") == f).alias(f"{f}s") for f in FAMILIES],
        F.avg(F.when(F.col("family") == "page", F.col("confidence").cast("double"))).alias("page_confidence"))
    whole = [F.array_join(F.transform(f, lambda v: v["text"]), join) for f, join in FAMILIES.items()]
    text = F.array_join(F.filter(F.array(*whole), lambda x: x != ""), "\n\n")
    return rows.select("document_id", text.alias("text"), *[f"{f}s" for f in FAMILIES], "page_confidence")


def blocks_to_text(lines: DataFrame, least: int = 80, blank: str = "[blank page]") -> DataFrame:
    """Pages' lines in reading order as one text; lines under `least` confidence
    are dropped, and a page left empty is marked.

    lines has document_id, page, line (top, left, text) and confidence.
    """
    good = F.when(F.col("confidence") >= least, F.col("line"))
    pages = lines.groupBy("document_id", "page").agg(F.array_sort(F.collect_list(good)).alias("lines"))
    text = F.when(F.size("lines") > 0, F.array_join(F.transform("lines", lambda v: v["text"]), "\n")).otherwise(blank)
    last = pages.groupBy("document_id").agg(F.map_from_entries(F.collect_list(F.struct("page", text.alias("text")))).alias("by_page"), F.max("page").alias("pages"))
    every = F.transform(F.sequence(F.lit(1), F.col("pages")), lambda p: F.coalesce(F.try_element_at("by_page", p), F.lit(blank)))
    return last.select("document_id", "pages", F.array_join(every, "\n\n").alias("text"))
