"""A Merkle manifest of a dataset, with proofs for every row (operator 12).

Nodes are labelled with the interval of leaf ranks that they cover.  A node's
parent is found by a join on the interval's bucket at the level above, in which
the parent's interval contains it; the parent's interval less its own leaves the
siblings, on its left and on its right.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import cut, documents
from folio.operators.ranking import numbered

FAN = 16
#: What a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of values, each `-` if null, else its UTF-8 byte count, `:` and itself."""
    told = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in told]), 256)


def _same(keys: list[str]) -> list[Column]:
    return [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]


def tree(leaves: DataFrame, keys: list[str], fan: int = FAN) -> list[DataFrame]:
    """The levels of the trees over leaves(*keys, lo, hi, digest, total), from the
    leaves up.  A node above has parts, the intervals and digests below it.

    total is the number of a key's leaves; keys of one node go no further up.
    Each level is written, and has a `fan`th of the rows of the one below.
    """
    levels, width = [leaves], fan
    largest = leaves.agg(F.max("total")).first()[0] or 0
    while width < largest * fan:
        below = levels[-1].where(F.col("total") > width // fan)
        made = below.groupBy(*keys, F.floor(F.col("lo") / width).alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("parts"), F.max("total").alias("total"))
        digest = F.sha2(F.array_join(F.transform("parts", lambda x: x["digest"]), ""), 256)
        made = made.select(*keys, F.col("parts")[0]["lo"].alias("lo"), F.element_at("parts", -1)["hi"].alias("hi"), digest.alias("digest"), "total", "parts")
        levels.append(cut(made, "manifest-level"))
        width *= fan
    return levels


def tops(levels: list[DataFrame], keys: list[str], fan: int = FAN) -> DataFrame:
    """(*keys, digest): what remains of each key's tree."""
    ends = [nodes.where((F.col("total") <= fan**i) & ((F.col("total") > fan ** (i - 1)) if i else F.lit(True))).select(*keys, "digest") for i, nodes in enumerate(levels)]
    return reduce(DataFrame.unionByName, ends)


def proofs(levels: list[DataFrame], keys: list[str], start: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves with `path`, (before, after) digests of their siblings at each
    level, joined, from the leaves up; start(*keys, path, ...) has what is above
    each key's tree, and further columns that go along."""
    along = [c for c in start.columns if c not in keys]
    above = None
    for i in reversed(range(len(levels))):
        child = levels[i].alias("c")
        own = [F.col(f"c.{x}") for x in levels[i].columns]
        ends = child.where(F.col("total") <= fan**i).join(start.alias("p"), reduce(and_, _same(keys), F.lit(True))).select(*own, *[F.col(f"p.{x}") for x in along])
        if above is not None:
            width = fan ** (i + 1)
            bucket = F.floor(F.col("c.lo") / width) == F.floor(F.col("p.lo") / width)
            inside = (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi"))
            side = lambda far: F.array_join(F.transform(F.filter("p.parts", far), lambda x: x["digest"]), "")
            step = F.struct(side(lambda x: x["hi"] <= F.col("c.lo")).alias("before"), side(lambda x: x["lo"] >= F.col("c.hi")).alias("after"))
            path = F.concat(F.array(step), F.col("p.path")).alias("path")
            met = child.where(F.col("total") > fan**i).join(above.alias("p"), reduce(and_, [*_same(keys), bucket, inside]))
            ends = ends.unionByName(met.select(*own, *[path if x == "path" else F.col(f"p.{x}") for x in along]))
        above = ends
    return above


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, at: F.sha2(F.concat(at["before"], digest, at["after"]), 256))


def manifest(docs: DataFrame, altered: Column | None = None, fan: int = FAN) -> DataFrame:
    """Leaf, subroot, root and proof of every row of docs, and the root that its
    proof gives with the digest of `altered` (a leaf made of other values; by
    default and where null, its own).

    A leaf is the digest of doc_id, source, lang, n_chars and text.  The leaves
    of a source in ascending order of doc_id (null first; rows that share one by
    digest) are hashed in runs of `fan`, until one node remains, the subroot;
    subroots by source (null first, bytewise) likewise, which gives the root.
    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Any column may be null or empty; texts may be of any length and are read
    once, where they lie.  Repeated rows are leaves of their own, further columns
    are ignored, and an empty table gives no rows.  Ranks come from ranges, so a
    source that holds most rows is spread over tasks; a task holds `fan` digests
    of a node and the path above it.
    """
    values = [F.col(c) for c in FIELDS]
    other = F.coalesce(altered if altered is not None else F.lit(None).cast("string"), F.lit(None).cast("string"))
    leaves = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_digest(*values).alias("digest"), other.alias("altered")), "manifest-leaves")
    ranked = numbered(leaves, ["source"], ["doc_id", "digest"], "lo", "total").withColumn("hi", F.col("lo") + 1)
    levels = tree(cut(ranked, "manifest-ranked"), ["source"], fan)

    roots = cut(tops(levels, ["source"], fan), "manifest-subroots")
    roots = cut(numbered(roots, [], ["source"], "lo", "total").withColumn("hi", F.col("lo") + 1), "manifest-sources")
    upper = tree(roots, [], fan)
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    start = proofs(upper, [], tops(upper, [], fan).select(nothing.alias("path"), F.col("digest").alias("root")), fan)
    start = cut(start.select("source", F.col("digest").alias("subroot"), "root", "path"), "manifest-roots")

    rows = proofs(levels, ["source"], start, fan)
    shown = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["before"], x["after"])), ""), 256)
    rows = rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", shown.alias("proof_sha256"), folded(F.col("path"), F.coalesce("altered", "digest")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark, sf_dir):
    """Every row; where 5 divides the CRC of doc_id, its text is lower-cased before it is verified."""
    *rest, text = [F.col(c) for c in FIELDS]
    lowered = leaf_digest(*rest, F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return manifest(documents(spark, sf_dir), F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lowered))
