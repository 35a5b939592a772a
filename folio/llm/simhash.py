"""SimHash near-duplicate detection by Golay-code fuzzy hashing (operator 11).

A fingerprint of 64 bits is cut into three parts.  Of two fingerprints that
differ in at most two bits, one part at least is equal (pigeonhole), and in any
window of 23 bits beside it they differ in at most two.  The perfect binary
Golay code puts every such window under the indices of the codewords nearest to
it, one or six, so that windows at distance two or less share an index.  Equal
part and shared index make the bucket in which two fingerprints meet.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, texts
from folio.llm.components import components

SHINGLE, SEED, BITS = 3, 42, 64
#: Differing bits up to which fingerprints are linked; the code's indices bear no more.
DISTANCE = 2
#: First bit and width of the parts of which one is equal; a window of 23 follows each.
PARTS = ((0, 21), (21, 21), (42, 22))
#: Members up to which a bucket's fingerprints are compared pair by pair.
BUCKET = 16
#: Shingles whose bits are counted at a time.
_STEP = 1 << 16

#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0xC75


def fingerprint(text: bytes) -> int:
    """The SimHash of a text's word shingles; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z and \x20, \x09-\x0D only
    if not words:
        return 0
    whole = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(SHINGLE, len(words))
    begin, end = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(begin), _STEP):
        some = [digest(whole[a:z], SEED) for a, z in zip(begin[at : at + _STEP], end[at : at + _STEP])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def _prints(batches):
    for batch in wb.text_chunks(batches, "text"):
        found = [fingerprint(x or b"") for x in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "print"])


@lru_cache(maxsize=1)
def _coset_patterns() -> tuple[np.ndarray, np.ndarray]:
    """(remainders of the 12 message bits, and by syndrome the error patterns that
    lead to the nearest codewords: the one of weight 3 or less, and where that is
    3 the five of weight 4 as well; -1 fills up)."""
    rest = np.zeros(1 << 12, np.int32)
    for message in range(1 << 12):
        value = message << 11
        for bit in range(22, 10, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - 11)
        rest[message] = value
    near, used = np.full((1 << 11, 6), -1, np.int32), np.zeros(1 << 11, np.int32)
    for weight in range(5):
        for at in combinations(range(23), weight):
            pattern = sum(1 << b for b in at)
            syndrome = int(rest[pattern >> 11]) ^ pattern & 0x7FF
            if weight < 4 or bin(int(near[syndrome, 0])).count("1") == 3:
                near[syndrome, used[syndrome]] = pattern
                used[syndrome] += 1
    return rest, near


def golay_indices(windows: np.ndarray) -> np.ndarray:
    """For each 23-bit window the indices of its nearest codewords (1 or 6; -1 fills up)."""
    rest, near = _coset_patterns()
    windows = windows.astype(np.int32)
    patterns = near[rest[windows >> 11] ^ windows & 0x7FF]
    return np.where(patterns >= 0, (windows[:, None] ^ patterns) >> 11, -1)


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of uint64 fingerprints: 3 to 18 buckets each."""
    rows, keys = [], []
    for part, (low, width) in enumerate(PARTS):
        turned = prints >> wb.U(low) | prints << wb.U((BITS - low) % BITS)  # the part's bits first
        equal = (turned & wb.U((1 << width) - 1)).astype(np.int64)
        index = golay_indices((turned >> wb.U(width) & wb.U((1 << 23) - 1)).astype(np.int64))
        row, at = np.nonzero(index >= 0)
        rows.append(row)
        keys.append((equal[row] << 14) + (index[row, at].astype(np.int64) << 2) + part)
    return np.concatenate(rows), np.concatenate(keys)


def _buckets(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy()
        row, key = bucket_keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints[row])], names=["bucket", "print"])


def links(prints: DataFrame) -> DataFrame:
    """a < b: links of distinct fingerprints (column print) whose components are
    those of all pairs that differ in DISTANCE bits or fewer.

    Buckets of at most BUCKET members are joined with themselves and verified in
    the join.  Of larger ones no pairs are made: a member is put under itself and
    its 64 neighbours at one bit.  Two that differ in at most two bits share such
    a point, and any two that share one differ in at most two; so the smallest of
    a point (which has 65 members at most) stands for all links there.
    """
    keyed = prints.select("print").mapInArrow(_buckets, "bucket long, print long")
    sizes = cut(keyed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "simhash-buckets")
    shared = cut(keyed.join(sizes, "bucket"), "simhash-shared")
    small, large = shared.where(F.col("members") <= BUCKET), shared.where(F.col("members") > BUCKET)
    a, b = small.select("bucket", F.col("print").alias("a")), small.select("bucket", F.col("print").alias("b"))
    alike = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = a.withColumnRenamed("bucket", "own").join(b, (F.col("own") == F.col("bucket")) & (F.col("a") < F.col("b")) & alike)
    flips = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    points = large.select("print").distinct().withColumn("flip", F.explode(flips))
    points = points.select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("point"))
    stars = points.select(F.min("print").over(Window.partitionBy("point")).alias("a"), F.col("print").alias("b")).where("a < b")
    return cut(pairs.select("a", "b").distinct().union(stars.distinct()), "simhash-links")


def fingerprint_groups(docs: DataFrame) -> DataFrame:
    """Group documents whose 64-bit SimHash fingerprints differ in two bits or fewer.

    Words are runs of bytes other than space and \\t..\\r, A-Z lower-cased;
    features are the XXH64 hashes (seed 42) of three consecutive words joined by
    a space, repeats included; of one or two words, the whole sequence.  A bit is
    1 if over half the hashes have it.  Returns one row per row of docs: doc_id,
    fingerprint (16 hex digits) and component_id, the smallest doc_id reachable
    over links, its own included.

    A null, empty or blank text has fingerprint zero and is linked like any
    other.  Rows are told apart as rows: a doc_id on several texts links none of
    them, and a repeated row repeats.  A row without doc_id is linked too, and
    bridges others; component_id is null where its component has no doc_id.
    Further columns are ignored; an empty table gives no rows.  Texts are read
    once and never shuffled; equal fingerprints count once in the search.
    """
    sketch = cut(texts(docs).mapInArrow(_prints, "doc_id long, print long"), "simhash-prints")
    classes = cut(sketch.groupBy("print").agg(F.min("doc_id").alias("low")), "simhash-classes")
    labels = components(links(classes), "simhash").withColumnRenamed("node", "print")
    placed = cut(classes.join(labels, "print", "left").withColumn("component", F.coalesce("component", "print")), "simhash-placed")
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = cut(placed.join(lowest, "component").select("print", "component_id"), "simhash-named")
    return sketch.join(named, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op11_simhash(spark, sf_dir):
    return fingerprint_groups(documents(spark, sf_dir))
