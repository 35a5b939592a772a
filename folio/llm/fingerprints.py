"""Document fingerprints by SpotSigs (operator 4).  DataFrame functions only.

A signature is a common-word anchor with the next two content words after it;
the set of a document's signatures is its fingerprint.  Sets are compared by
Jaccard, after pruning by set length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import cut, documents, texts

#: Anchors, common words of four languages.
ANCHORS = (
    "the of and to a in is it that this for on with as be was by are at from or an not which have had "
    "der die das und zu den von mit ist im ein eine nicht auf für des dem sich es auch "
    "le la les de des du et un une en est que qui dans pour pas sur au avec par "
    "el los las y del al por con una su se lo como más"
).split()
CHAIN = 2
#: One word in so many, by hash, is an anchor whatever the language.
RARE_ANCHORS = 16
#: A chain that isn't complete this many words after its anchor is no signature.
REACH = 12
FAN = 250
START = "^"


def signatures(text: Column, chain: int = CHAIN, reach: int = REACH) -> Column:
    """Sorted distinct 32-bit hashes of a text's signatures.

    Words are runs of letters and digits, lower-cased.  Anchors are the listed
    common words, one word in RARE_ANCHORS by its hash, and the start of the
    text, so texts of any language have signatures all along.  A text without
    any, being shorter than a chain, has its own hash as the only one; just the
    empty text has none.
    """
    anchors = sorted(set(ANCHORS))
    words = F.concat(F.array(F.lit(START)), F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    found = F.transform(
        F.array(words),  # bound once
        lambda ws: F.array_sort(
            F.array_distinct(
                F.transform(
                    F.filter(
                        F.transform(
                            ws,
                            lambda w, i: F.when(
                                w.isin([*anchors, START]) | (F.pmod(F.hash(w), F.lit(RARE_ANCHORS)) == 0),
                                F.concat(F.array(w), F.slice(F.filter(F.slice(ws, i + 2, reach), lambda v: ~v.isin(anchors)), 1, chain)),
                            ),
                        ),
                        lambda spot: F.size(spot) == chain + 1,
                    ),
                    lambda spot: F.hash(spot),
                )
            )
        ),
    )
    own = lambda sigs: F.when((F.size(sigs) == 0) & (text != ""), F.array(F.hash(text))).otherwise(sigs)
    return F.transform(found, own)[0]


def fingerprint(sigs: Column) -> Column:
    """The set as text: eight hex digits for each signature, ascending."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets; two empty sets are alike (1)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def next_keys(keys: DataFrame, span: int, fan: int = FAN) -> DataFrame:
    """key -> following: the next larger key, null after the last.

    A tree of windows: within runs of `fan` key values by a window, across runs
    by the same on the runs' numbers.  No window holds more than `fan` keys,
    however the keys are spread.  keys has distinct longs; span bounds their range.
    """
    runs = keys.withColumn("run", F.floor(F.col("key") / F.lit(fan)).cast("long"))
    within = Window.partitionBy("run").orderBy("key")
    here = runs.withColumn("following", F.lead("key").over(within))
    if span <= 1:
        return here.select("key", "following")
    firsts = cut(runs.groupBy("run").agg(F.min("key").alias("first")), "next-runs")
    after = next_keys(firsts.select(F.col("run").alias("key")), span // fan, fan)
    entry = firsts.select(F.col("run").alias("following"), "first")
    step = after.join(entry, "following").select(F.col("key").alias("run"), "first")
    return here.join(step, "run", "left").select("key", F.coalesce("following", "first").alias("following"))


def with_next(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """docs(doc_id, text) with sigs, and text and sigs of the next document.

    Next is by ascending doc_id (null ids first, equal ids by text), after the
    last comes the first.  Texts are shuffled once, to runs of `fan` ids; the
    first document of each run is copied to the end of the run before it.
    """
    docs = docs.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 62))))
    docs = docs.withColumn("run", F.floor(F.col("id") / F.lit(fan)).cast("long"))
    heads = cut(docs.groupBy("run").agg(F.min("id").alias("id")), "fingerprint-heads")
    low, high = heads.agg(F.min("run"), F.max("run")).first()
    if low is None:
        empty = F.lit(None).cast("array<int>")
        return docs.select("doc_id", "text", empty.alias("sigs"), F.col("text").alias("next_text"), empty.alias("next_sigs"))
    after = next_keys(heads.select(F.col("run").alias("key")), high - low + 1, fan)
    after = after.select(F.col("key").alias("before"), F.coalesce("following", F.lit(low)).alias("run"))
    guide = cut(heads.join(after, "run").select("id", "before"), "fingerprint-guide")
    guests = docs.join(guide, "id").select("doc_id", "text", "id", F.col("before").alias("run"), F.lit(1).alias("guest"))
    rows = docs.select("doc_id", "text", "id", "run", F.lit(0).alias("guest")).union(guests)
    rows = rows.withColumn("sigs", signatures(F.coalesce("text", F.lit(""))))
    order = Window.partitionBy("run").orderBy("guest", "id", "text")
    rows = rows.withColumn("next_text", F.lead(F.coalesce("text", F.lit(""))).over(order)).withColumn("next_sigs", F.lead("sigs").over(order))
    return rows.where("guest = 0").select("doc_id", "text", "sigs", "next_text", "next_sigs")


def near_pairs(fingerprints: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Pairs (a < b, likeness) of different signature sets that are alike.

    fingerprints has doc_id and sigs.  Documents of equal sets are one class,
    named by its smallest doc_id; pairs are of classes, copies are not expanded
    (equal fingerprints tell them).  Sets are partitioned by length, so that
    partners are in one partition or the next; signatures are ordered by how
    many classes have them, and a pair must share one among the rarest that the
    threshold leaves room for; what remains is verified in full.  Empty sets
    have no partners; null sets and ids are left out.
    """
    named = fingerprints.where("doc_id is not null and size(sigs) > 0").withColumn("same", F.sha2(fingerprint(F.col("sigs")), 256))
    classes = cut(named.groupBy("same").agg(F.min("doc_id").alias("class"), F.first("sigs").alias("sigs")), "spots-classes")
    spots = classes.select("class", F.explode("sigs").alias("sig"))
    rare = cut(spots.groupBy("sig").agg(F.count("*").alias("often")).where("often > 1"), "spots-counts")
    ranked = spots.join(rare, "sig").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("often", "sig"))).alias("ranked"))
    n = F.size("sigs")
    part = F.floor(F.log(n) / F.lit(math.log(1 / threshold)) + 1e-9).cast("int")
    # signatures that one class alone has are the rarest; they take up the prefix but meet nothing
    room = F.greatest(n - F.ceil(n * threshold).cast("int") + 1 - (n - F.size("ranked")), F.lit(0))
    lead = F.transform(F.slice("ranked", F.lit(1), room), lambda x: x["sig"])
    index = cut(classes.join(ranked, "class").select("class", n.alias("n"), part.alias("part"), F.explode(lead).alias("sig")), "spots-index")
    probe = index.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "sig")
    close = F.least("n", "n_b") >= threshold * F.greatest("n", "n_b")
    pairs = index.join(probe, ["part", "sig"]).where((F.col("class") != F.col("b")) & close)
    pairs = pairs.select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b")).distinct()
    left = classes.select(F.col("class").alias("a"), F.col("sigs").alias("sigs_a"))
    right = classes.select(F.col("class").alias("b"), F.col("sigs").alias("sigs_b"))
    value = likeness(F.col("sigs_a"), F.col("sigs_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", value.alias("likeness")).where(F.col("likeness") >= threshold)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per row of docs: its fingerprint, and likeness to its edited text
    and to the next document.

    The edited text replaces the last quarter (floor(n_chars / 4) code points)
    by the first as many code points of the next document's text, or all of it.
    Returns doc_id, n_chars, edited_sha256 (of the edited text in UTF-8),
    fingerprint, edited_fingerprint, near_edited, near_next, n_signatures.
    A null text is empty, and has the empty fingerprint, like no other text's.
    A single document is its own next.  Rows that repeat an id follow each other
    by text.  Further columns are ignored.
    """
    rows = with_next(texts(docs)).withColumn("text", F.coalesce("text", F.lit("")))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sigs", "next_sigs")
    rows = rows.withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").cast("long").alias("n_signatures"),
    )


def op4_fingerprints(spark, sf_dir):
    return fingerprint_documents(documents(spark, sf_dir))
