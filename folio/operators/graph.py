"""Edges between documents, chunks, mentions and canonical entities."""

from __future__ import annotations

import re
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import find_all


#: Entities of a document in one part; two parts are paired in one task.
PART = 512


def cooccurrence(mentions: DataFrame, part: int | None = None) -> DataFrame:
    """CO_OCCURS edges between the distinct canonicals of a document (a < b).

    A document's entities are dealt out into parts of about `part`, and each two
    parts (or a part with itself) meet under a key of their own, so that the
    pairs of a document with many entities are made in many tasks.
    """
    part = part or PART
    nodes = mentions.select("document_id", "canonical_id").distinct()
    parts = nodes.groupBy("document_id").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    placed = nodes.join(parts, "document_id").withColumn("own", F.pmod(F.xxhash64("canonical_id"), F.col("parts")).cast("int"))
    low = placed.select("document_id", F.col("own").alias("low"), F.explode(F.sequence("own", F.col("parts") - 1)).alias("high"), F.col("canonical_id").alias("a"))
    high = placed.select("document_id", F.explode(F.sequence(F.lit(0), "own")).alias("low"), F.col("own").alias("high"), F.col("canonical_id").alias("z"))
    pairs = low.join(high, ["document_id", "low", "high"]).where((F.col("low") < F.col("high")) | (F.col("a") < F.col("z")))
    return pairs.select("document_id", F.least("a", "z").alias("source_id"), F.greatest("a", "z").alias("target_id"), F.lit("CO_OCCURS").alias("relationship_type"))


def cooccurrence_counts(mentions: DataFrame) -> DataFrame:
    """(type1, type2, edges): how many CO_OCCURS edges join entities of two types
    (type1 <= type2), from each document's number of entities by type; no pair is made."""
    nodes = mentions.select("document_id", "entity_type", "canonical_id").distinct()
    n = nodes.groupBy("document_id", "entity_type").agg(F.count("*").alias("n"))
    a, z = (n.select("document_id", F.col("entity_type").alias(f"type{i}"), F.col("n").alias(f"n{i}")) for i in (1, 2))
    both = a.join(z, "document_id").where("type1 <= type2")  # as many rows as a document has pairs of types
    edges = F.when(F.col("type1") == F.col("type2"), F.expr("n1 * (n1 - 1) div 2")).otherwise(F.col("n1") * F.col("n2"))
    return both.groupBy("type1", "type2").agg(F.sum(edges).alias("edges")).where("edges > 0")


def structural(chunks: DataFrame, mentions: DataFrame, project: str = "source") -> DataFrame:
    """BELONGS_TO, CONTAINS_MENTION, MEMBER_OF_CLUSTER and NEXT_/PREVIOUS_CHUNK: all
    edges of a chunk, and of a mention, from one pass over each.  A document
    belongs to the project of its first chunk."""
    doc = F.concat(F.lit("d"), F.col("document_id"))
    chunk = F.concat(doc, F.lit("c"), F.col("chunk_index"))
    order = Window.partitionBy("document_id").orderBy("chunk_index")
    there = F.concat(doc, F.lit("c"), F.lead("chunk_index").over(order))

    def edge(source, target, kind, given=None):
        made = F.struct(source.alias("source_id"), target.alias("target_id"), F.lit(kind).alias("relationship_type"))
        return made if given is None else F.when(given, made)

    rows = chunks.select(chunk.alias("here"), there.alias("there"), doc.alias("doc"), F.col(project).alias("project"), (F.row_number().over(order) == 1).alias("first"))
    here, follows = F.col("here"), F.col("there").isNotNull()
    of_chunks = F.array(
        edge(here, F.col("doc"), "BELONGS_TO"), edge(F.col("doc"), F.col("project"), "BELONGS_TO", F.col("first")),
        edge(here, F.col("there"), "NEXT_CHUNK", follows), edge(F.col("there"), here, "PREVIOUS_CHUNK", follows))
    mention = F.concat(chunk, F.col("entity_type"), F.col("ordinal"))
    of_mentions = F.array(edge(chunk, mention, "CONTAINS_MENTION"), edge(mention, F.col("canonical_id"), "MEMBER_OF_CLUSTER"))
    return rows.select(F.inline(F.array_compact(of_chunks))).unionByName(mentions.select(F.inline(of_mentions)))


def best_edges(edges: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Per (source, target, type) the edge of highest confidence."""
    keys = ["source_id", "target_id", "relationship_type"]
    rest = [c for c in edges.columns if c not in keys]
    best = edges.groupBy(*keys).agg(F.max(F.struct(confidence, *[c for c in rest if c != confidence])).alias("_best"))
    return best.select(*keys, "_best.*")


#: Templates of stated relationships, their type and confidence.
PATTERNS = (
    (r"{entity1}\s+(?:v\.?|versus|against)\s+{entity2}", "OPPOSING_PARTY", 0.9),
    (r"{entity1}.*?(?:plaintiff|petitioner|claimant).*?{entity2}.*?(?:defendant|respondent)", "PLAINTIFF_V_DEFENDANT", 0.85),
    (r"{entity2}.*?(?:defendant|respondent).*?{entity1}.*?(?:plaintiff|petitioner|claimant)", "PLAINTIFF_V_DEFENDANT", 0.85),
    (r"{entity1}\s+(?:represents?|represented\s+by|counsel\s+for)\s+{entity2}", "REPRESENTS", 0.8),
    (r"{entity2}\s+(?:represented\s+by|retained)\s+{entity1}", "REPRESENTS", 0.8),
    (r"{entity1}\s+(?:is|was|serves?\s+as)\s+(?:an?\s+)?(?:employee|officer|director)\s+(?:of|at)\s+{entity2}", "EMPLOYED_BY", 0.85),
    (r"{entity1}\s+(?:works?|worked)\s+(?:for|at)\s+{entity2}", "EMPLOYED_BY", 0.8),
    (r"{entity1}\s+(?:is|was)\s+(?:a\s+)?(?:subsidiary|division|unit)\s+of\s+{entity2}", "SUBSIDIARY_OF", 0.9),
    (r"{entity1}\s+(?:owns?|owned|acquired)\s+{entity2}", "OWNS", 0.85),
    (r"{entity1}\s+(?:located|based|headquartered)\s+(?:in|at)\s+{entity2}", "LOCATED_IN", 0.8),
    (r"{entity1}.*?(?:a\s+)?{entity2}\s+(?:corporation|company|entity)", "INCORPORATED_IN", 0.75),
    (r"{entity1}\s+(?:entered\s+into|signed|executed)\s+(?:a\s+)?(?:contract|agreement)\s+with\s+{entity2}", "CONTRACT_WITH", 0.85),
    (r"(?:contract|agreement)\s+between\s+{entity1}\s+and\s+{entity2}", "CONTRACT_WITH", 0.9),
    (r"{entity1}\s+(?:paid|pays|owed|owes)\s+.*?\s+to\s+{entity2}", "FINANCIAL_TRANSACTION", 0.8),
    (r"{entity2}\s+(?:received|receives)\s+.*?\s+from\s+{entity1}", "FINANCIAL_TRANSACTION", 0.8),
    (r"{entity1}.*?(?:on|dated?)\s+{entity2}", "OCCURRED_ON", 0.7),
    (r"{entity1}.*?(?:filed|submitted|served).*?{entity2}", "FILED_ON", 0.75),
)
#: White space, as patterns know it.
WHITE = " \t\n\x0b\f\r"
#: For each template, words of whose groups one each stands wherever it does.
WORDS = (
    (("v", "against"),),
    (("plaintiff", "petitioner", "claimant"), ("defendant", "respondent")),
    (("plaintiff", "petitioner", "claimant"), ("defendant", "respondent")),
    (("represent", "counsel"),),
    (("represented", "retained"),),
    (("employee", "officer", "director"),),
    (("work",),),
    (("subsidiary", "division", "unit"),),
    (("own", "acquired"),),
    (("located", "based", "headquartered"),),
    (("corporation", "company", "entity"),),
    (("entered", "signed", "executed"),),
    (("contract", "agreement"), ("between",)),
    (("paid", "pays", "owed", "owes"),),
    (("receive",),),
    (("on", "date"),),
    (("filed", "submitted", "served"),),
)
#: Types that a relationship may join; ANY lets every pair pass.
TYPES_OF = {
    "OPPOSING_PARTY": (("PERSON", "PERSON"), ("PERSON", "ORG"), ("ORG", "ORG")),
    "PLAINTIFF_V_DEFENDANT": (("PERSON", "PERSON"), ("PERSON", "ORG"), ("ORG", "ORG")),
    "REPRESENTS": (("PERSON", "PERSON"), ("PERSON", "ORG"), ("ORG", "PERSON"), ("ORG", "ORG")),
    "EMPLOYED_BY": (("PERSON", "ORG"),),
    "SUBSIDIARY_OF": (("ORG", "ORG"),),
    "OWNS": (("PERSON", "ORG"), ("ORG", "ORG")),
    "LOCATED_IN": (("PERSON", "LOCATION"), ("ORG", "LOCATION")),
    "INCORPORATED_IN": (("ORG", "LOCATION"),),
    "CONTRACT_WITH": (("PERSON", "PERSON"), ("PERSON", "ORG"), ("ORG", "ORG")),
    "FINANCIAL_TRANSACTION": (("PERSON", "PERSON"), ("PERSON", "ORG"), ("ORG", "ORG")),
    "OCCURRED_ON": (("ANY", "DATE"),),
    "FILED_ON": (("PERSON", "DATE"), ("ORG", "DATE")),
}
#: Words near a match, each of which adds 0.05.
BOOSTS = {
    "OPPOSING_PARTY": ("plaintiff", "defendant", "petitioner", "respondent", "lawsuit"),
    "REPRESENTS": ("attorney", "lawyer", "counsel", "law firm", "representation"),
    "EMPLOYED_BY": ("employee", "worked", "position", "title", "department"),
    "CONTRACT_WITH": ("agreement", "contract", "terms", "obligations", "parties"),
    "FINANCIAL_TRANSACTION": ("paid", "payment", "invoice", "amount", "dollars", "$"),
}


def _allowed(type1: str, type2: str) -> Column:
    """Bits of the templates that may join entities of two types."""
    bits: dict[str, int] = {}
    always = 0
    for k, (_, kind, _) in enumerate(PATTERNS):
        if any("ANY" in pair for pair in TYPES_OF[kind]):
            always |= 1 << k
        for pair in TYPES_OF[kind]:
            bits[",".join(pair)] = bits.get(",".join(pair), 0) | 1 << k
    listed = F.create_map(*[F.lit(x) for item in bits.items() for x in item])
    return F.coalesce(F.try_element_at(listed, F.concat_ws(",", type1, type2)), F.lit(0)).bitwiseOR(F.lit(always))


def stated_edges(chunks: DataFrame, least: float = 0.7, around: int = 50, apart: int = 100) -> DataFrame:
    """Relationships stated in chunks, the most confident of each source, target
    and type in a chunk, with what stands `around` the match.

    chunks has document_id, chunk_index, chunk_text and names, an array of
    (entity_id, entity_type, name) with an element for each name or alias.  Just
    names that stand in the chunk are paired, and a pair meets the templates its
    types allow, whose words stand in the chunk, and whose middle stands between
    the first of the one name and the last of the other; the few that are left are
    searched for in full.  Words near by add 0.05 each, names over `apart`
    characters from each other take 0.1; confidence is at most 0.95 and at least
    `least`.
    """
    keys = ["document_id", "chunk_index"]
    rows = chunks.select(*keys, "chunk_text", "names", F.lower("chunk_text").alias("low"), F.length("chunk_text").alias("size"))
    stands = [[[F.col("low").contains(w) for w in words] for words in groups] for groups in WORDS]
    open_ = [reduce(and_, [reduce(or_, words) for words in groups]) for groups in stands]
    # lower case keeps places, but where it makes two letters of one or looks at those beside it
    plain = (F.length("low") == F.col("size")) & ~F.col("chunk_text").contains("\u03a3")
    rows = rows.select(
        *keys, "chunk_text", "names", "low", "size", F.reverse("low").alias("back"), plain.alias("plain"),
        reduce(add, [F.when(o, 1 << k).otherwise(0) for k, o in enumerate(open_)]).alias("open"))

    def place(n: Column) -> Column:
        """Where the first and the last of a name are: start from 0, stop, last and end from 1."""
        name, length = F.lower(n["name"]), F.length(n["name"])
        first, back = F.call_function("instr", F.col("low"), name), F.call_function("instr", F.col("back"), F.reverse(name))
        last = F.col("size") - back - length + 2
        spot = [(first - 1, 0, "start"), (first + length, 1, "stop"), (last, F.col("size") + 1, "last"), (last + length - 1, 0, "end"), (first == last, False, "once")]
        return F.struct(n["entity_id"].alias("id"), n["entity_type"].alias("type"), n["name"].alias("name"), *[F.when(F.col("plain"), x).otherwise(y).alias(c) for x, y, c in spot])

    seen = F.transform(F.filter("names", lambda n: F.col("low").contains(F.lower(n["name"])) & (F.length(n["name"]) > 0)), place)
    rows = rows.select(*keys, "chunk_text", "open", F.when(F.col("open") != 0, seen).alias("seen"))
    # explode() would have seen made once more, for a filter on its size
    pairs = rows.select("*", F.explode_outer("seen").alias("a")).select(*keys, "chunk_text", "open", "a", F.explode_outer("seen").alias("z")).where("a.id <> z.id")
    between = lambda x, y: F.when(F.col(f"{x}.stop") <= F.col(f"{y}.last"), F.substring(F.col("chunk_text"), F.col(f"{x}.stop"), F.col(f"{y}.last") - F.col(f"{x}.stop")))
    side = lambda x, i: [F.col(f"{x}.{c}").alias(f"{c}{i}") for c in ("id", "type", "name", "start", "end")]
    # bits of the templates whose types and words are right
    turned = [template.index("{entity1}") > template.index("{entity2}") for template, _, _ in PATTERNS]
    backward = sum(1 << k for k, x in enumerate(turned) if x)
    may = F.col("open").bitwiseAND(_allowed("a.type", "z.type"))
    pairs = pairs.select("*", may.alias("may")).where("may <> 0")
    pairs = pairs.select(*keys, "chunk_text", "may", *side("a", 1), *side("z", 2), between("a", "z").alias("ahead"),
        F.when(F.col("may").bitwiseAND(F.lit(backward)) != 0, between("z", "a")).alias("behind"), (F.col("a.once") & F.col("z.once")).alias("once"))
    tried, bare = [], []
    for k, (template, _, _) in enumerate(PATTERNS):
        before, middle, behind = re.split(r"\{entity[12]\}", template)
        bare.append(not before and not behind)
        over, loose = F.col("behind" if turned[k] else "ahead"), middle.removeprefix(".*?").removesuffix(".*?")
        stands_between = over.rlike(f"(?is){loose}")
        if bare[k]:  # where both names stand once, all of what is between them is the middle
            stands_between = F.when(F.col("once"), over.rlike(rf"(?is)\A{middle}\z")).otherwise(stands_between)
        tried.append(F.when((F.col("may").bitwiseAND(F.lit(1 << k)) != 0) & stands_between, k))
    tried = pairs.select(*keys, "chunk_text", "id1", "id2", "name1", "name2", "start1", "end1", "start2", "end2", "once", F.explode(F.array(*tried)).alias("k")).where("k is not null")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("k") + 1)
    template, kind, base = map(pick, zip(*PATTERNS))
    start, stop = (F.when(pick(turned), F.col(two)).otherwise(F.col(one)) for one, two in (("start1", "start2"), ("end2", "end1")))
    tried = tried.select("*", template.alias("template"), kind.alias("relationship_type"), base.alias("base"), (F.col("once") & pick(bare)).alias("sure"), F.struct(start.alias("start"), stop.alias("stop")).alias("only"))
    quoted = lambda c: F.concat(F.lit("\\Q"), F.replace(F.col(c), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    pattern = F.replace(F.replace("template", F.lit("{entity1}"), quoted("name1")), F.lit("{entity2}"), quoted("name2"))
    every = F.transform(find_all(F.col("chunk_text"), F.concat(F.lit("(?is)"), pattern)), lambda x: F.struct(x["start"], x["stop"]))
    hits = tried.withColumn("hit", F.explode_outer(F.when(F.col("sure"), F.array("only")).otherwise(every))).where("hit.start is not null")
    begin = F.greatest(F.col("hit.start") - around, F.lit(0))
    context = F.trim(F.substring("chunk_text", begin + 1, F.col("hit.stop") + around - begin), F.lit(WHITE))
    rows = hits.withColumn("context", context).withColumn("low", F.lower("context"))
    near = {k: sum((F.col("low").contains(w).cast("int") for w in words[1:]), F.col("low").contains(words[0]).cast("int")) for k, words in BOOSTS.items()}
    boost = F.coalesce(*[F.when(F.col("relationship_type") == k, n) for k, n in near.items()], F.lit(0))
    at = lambda c: F.call_function("instr", F.col("low"), F.lower(c))
    far = (at("name1") > 0) & (at("name2") > 0) & (F.abs(at("name1") - at("name2")) > apart)
    confidence = F.least(F.lit(0.95), F.round(F.col("base") + 0.05 * boost - F.when(far, 0.1).otherwise(0.0), 6))
    rows = rows.select(*keys, F.col("id1").alias("source_id"), F.col("id2").alias("target_id"), "relationship_type", confidence.alias("confidence"), "context")
    best = F.max(F.struct("confidence", "context"))["context"].alias("context")  # not needed for the confidence
    return rows.groupBy(*keys, "source_id", "target_id", "relationship_type").agg(F.max("confidence").alias("confidence"), best).where(F.col("confidence") >= least)


def pattern_edges(chunks: DataFrame, entities: DataFrame, least: float = 0.7, around: int = 50, apart: int = 100) -> DataFrame:
    """stated_edges of chunks whose names are in another table.

    chunks has document_id, chunk_index, chunk_text; entities has document_id,
    entity_id, entity_type and a name, a row for each name or alias.
    """
    names = entities.where(F.length("name") > 0).groupBy("document_id").agg(F.collect_list(F.struct("entity_id", "entity_type", "name")).alias("names"))
    return stated_edges(chunks.join(names, "document_id"), least, around, apart)


#: Relations between two words, in this order.
WORD_PATTERNS = (
    (r"(\w+)\s+v\.?\s+(\w+)", "opposing_party"),
    (r"(\w+)\s+(?:is|was)\s+(?:an?\s+)?employee\s+of\s+(\w+)", "employment"),
    (r"(\w+)\s+represent(?:s|ed|ing)\s+(\w+)", "represents"),
    (r"(\w+)\s+(?:is|was)\s+a\s+subsidiary\s+of\s+(\w+)", "subsidiary"),
)


def word_relations(rows: DataFrame, most: int = 10, around: int = 20) -> DataFrame:
    """The first `most` relations between two words of a text that are both among
    its entities, in the order of the patterns, with confidence and context.

    rows has text and names (an array of entity names, of any case; of names that
    differ in case only, the last counts); its other columns are kept.
    """
    known = lambda word: F.element_at(F.filter("names", lambda n: F.lower(n) == F.lower(word)), -1)

    def of(pattern: str, kind: str) -> Column:
        one, two = (F.regexp_extract_all("text", F.lit(f"(?iU){pattern}"), F.lit(g)) for g in (1, 2))
        return F.zip_with(one, two, lambda a, z: F.struct(a.alias("a"), z.alias("z"), F.lit(kind).alias("kind")))

    words = rows.withColumn("found", F.concat(*[of(p, k) for p, k in WORD_PATTERNS]))
    both = F.filter("found", lambda x: F.exists("names", lambda n: F.lower(n) == F.lower(x["a"])) & F.exists("names", lambda n: F.lower(n) == F.lower(x["z"])))
    out = words.withColumn("x", F.explode(F.slice(both, 1, most)))
    begin = F.greatest(F.call_function("instr", F.col("text"), F.col("x.a")) - 1 - around, F.lit(0))
    end = F.call_function("instr", F.col("text"), F.col("x.z")) - 1 + around
    context = F.substring("text", begin + 1, F.greatest(end - begin, F.lit(0)))
    rest = [c for c in rows.columns if c not in ("text", "names")]
    return out.select(*rest, known(F.col("x.a")).alias("source_entity"), F.col("x.kind").alias("relationship_type"), known(F.col("x.z")).alias("target_entity"), F.lit(0.8).alias("confidence"), context.alias("context"))


def word_pair_edges(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """RELATED edges for "name of name", "name and name" and the like, where both
    names are known in the document.

    chunks has document_id and chunk_text; entities has document_id, canonical_id
    and a lower-cased name.
    """
    pattern = r"\b([a-z]{3,}) (?:of|and|in|de|und|y|et) ([a-z]{3,})\b"
    text = F.lower("chunk_text")
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("z"))
    rows = chunks.select("document_id", F.inline(pairs).alias("a", "z")).distinct()
    left = entities.select("document_id", F.col("name").alias("a"), F.col("canonical_id").alias("source_id"))
    right = entities.select("document_id", F.col("name").alias("z"), F.col("canonical_id").alias("target_id"))
    joined = rows.join(left, ["document_id", "a"]).join(right, ["document_id", "z"]).where("source_id <> target_id")
    return joined.select("document_id", "source_id", "target_id").distinct()
