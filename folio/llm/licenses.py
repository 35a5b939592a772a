"""License scans: phrase places, and notices found by an exact set-similarity
join of text blocks with notice templates (operator 6).  DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import cut, documents, texts

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices to look for, by label.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "copyright": "copyright c all rights reserved",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "warranty": "the software is provided as is without warranty of any kind express or implied",
}
CONTAINMENT = 0.9

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    tokens: frozenset[str]
    needed: int  # shared tokens that reach the containment threshold


def parsed(templates: dict[str, str], containment: float) -> list[Template]:
    sets = {label: frozenset(text.split()) for label, text in sorted(templates.items())}
    return [Template(label, tokens, math.ceil(containment * len(tokens))) for label, tokens in sets.items()]


def reach_of(templates: dict[str, str]) -> int:
    """Words that a passage may take to hold a notice: half as many again as the
    longest one's.  Blocks are twice as long and begin this far apart, so every
    passage of this length lies whole in a block, across line ends too."""
    return max((3 * len(text.split()) + 1) // 2 for text in templates.values())


def folded(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _starts(words: Column, text: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after another, from 0."""
    parts = phrase.split()
    here = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + j) == p for j, p in enumerate(parts)])
    likely = reduce(lambda a, b: a & b, [text.contains(p) for p in parts])
    places = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)
    return F.when(likely & (F.size(words) >= len(parts)), places).otherwise(F.array().cast("array<int>"))


def blocks_of(words: Column, templates: list[Template], reach: int) -> Column:
    """Array of (block, tokens): the distinct words that any template uses, of
    each block of 2 * reach words that has enough of them for some template."""
    vocabulary = sorted(frozenset().union(*[t.tokens for t in templates]))
    least = min(t.needed for t in templates)
    count = F.greatest(F.ceil(F.size(words) / F.lit(float(reach))).cast("int") - 1, F.lit(1))
    tokens = lambda b: F.array_distinct(F.filter(F.slice(words, b * reach + 1, 2 * reach), lambda w: w.isin(vocabulary)))
    every = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.struct(b.alias("block"), tokens(b).alias("tokens")))
    return F.filter(every, lambda x: F.size(x["tokens"]) >= least)


def ranks_of(blocks: DataFrame, templates: list[Template]) -> dict[str, int]:
    """The templates' tokens in the order of how many blocks have them, rarest first.

    Only their counts come back: as many rows as there are of these.
    """
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count()
    frequency = {r["token"]: r["count"] for r in counts.collect()}
    vocabulary = frozenset().union(*[t.tokens for t in templates])
    return {token: i for i, token in enumerate(sorted(vocabulary, key=lambda t: (frequency.get(t, 0), t)))}


def notices(blocks: DataFrame, templates: list[Template]) -> DataFrame:
    """doc_id, key, block, label, containment of every block that holds enough of
    a template's tokens.

    Exact set-similarity join.  In the global order, rarest first, a template
    and a block with enough tokens in common share one among the template's
    first (prefix); the block must have as many tokens as are needed (length);
    and from the place where they meet on, both must have them left (position).
    """
    ranks, least = ranks_of(blocks, templates), min(t.needed for t in templates)
    index = []
    for t in templates:
        tokens = sorted(ranks[x] for x in t.tokens)
        index += [(t.label, tokens, t.needed, token, i) for i, token in enumerate(tokens[: len(tokens) - t.needed + 1])]
    index = blocks.sparkSession.createDataFrame(index, "label string, template array<int>, needed int, token int, place int")
    table = F.create_map(*[F.lit(x) for item in ranks.items() for x in item])
    ranked = blocks.select("doc_id", "key", "block", F.array_sort(F.transform("tokens", lambda t: table[t])).alias("tokens"))
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - least + 1)
    shared = F.array_intersect("template", "tokens")
    return (
        ranked.select("doc_id", "key", "block", "tokens", F.posexplode(prefix).alias("spot", "token"))
        .join(index, "token")  # Spark knows the index's size, and broadcasts it if it is small
        .where(F.size("tokens") >= F.col("needed"))  # length
        .where(F.least(F.size("template") - F.col("place"), F.size("tokens") - F.col("spot")) >= F.col("needed"))  # position
        .where((F.array_min(shared) == F.col("token")) & (F.size(shared) >= F.col("needed")))  # once, where they meet first
        .select("doc_id", "key", "block", "label", (F.size(shared) / F.size("template")).alias("containment"))
    )


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """One row per row of docs, over whole texts (null: empty).

    n_words; n_base, first_word, last_word: how often a phrase's words stand one
    after another, the smallest and the largest start (words count from 0; null
    without a place); base_labels: labels of those phrases.  labels adds those
    of the templates of which a block of consecutive words, across line ends,
    holds at least `containment` of the distinct words (see reach_of).  score is
    the best containment, 1 where a phrase stands.  Labels are distinct, sorted
    and joined by commas; empty if there are none.  A null doc_id is a value
    like others; repeated rows stay; further columns are ignored.  An empty
    table gives an empty one.
    """
    known, reach = parsed(templates, containment), reach_of(templates)
    docs = texts(docs).select("doc_id", F.xxhash64("text").alias("key"), folded(F.col("text")).alias("text"))
    docs = docs.withColumn("words", words_of(F.col("text")))
    starts = [_starts(F.col("words"), F.col("text"), p).alias(f"{i}_places") for i, p in enumerate(phrases)]
    docs = docs.select(
        "doc_id", "key", F.size("words").cast("long").alias("n_words"), *starts, blocks_of(F.col("words"), known, reach).alias("blocks")
    )
    docs = cut(docs, "license-words")  # texts are taken apart once
    found = (
        notices(docs.select("doc_id", "key", F.inline("blocks")), known)
        .groupBy("doc_id", "key")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
        .select(F.col("doc_id").alias("found_id"), F.col("key").alias("found_key"), "more", "best")
    )
    spots = [F.col(f"{i}_places") for i in range(len(phrases))]
    places = F.flatten(F.array(*spots))
    hit = F.array_compact(F.array(*[F.when(F.size(spot) > 0, F.lit(label)) for spot, label in zip(spots, phrases.values())]))
    base = docs.select("doc_id", "key", "n_words", places.alias("places"), hit.alias("hit"))
    own = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    every = F.array_union("hit", F.coalesce("more", F.array().cast("array<string>")))
    return base.join(found, own, "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("hit")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("hit") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op6_license_scan(spark, sf_dir):
    return scan_licenses(documents(spark, sf_dir))
