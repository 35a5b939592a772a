"""MinHash near-duplicate detection (operator 9).

One-permutation hashing with optimal densification gives each document a
signature; signature bands are buckets; every bucket contributes a star of
candidate edges around its smallest member instead of all its pairs; links are
confirmed on the full shingle sets.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, group_rows, spare, texts
from folio.llm.components import components

SHINGLE = 5
BANDS, BAND_ROWS = 48, 6
#: Members of a bucket that are held against each other in one task, and their
#: shingles; of larger buckets just those whose rarest shingles meet are.
TILE_DOCUMENTS, TILE_SHINGLES = 2048, 1 << 20
#: Rows whose shared shingles are counted at a time, and cells of a block of shingles.
STRIP, BLOCK_CELLS = 256, 4_000_000
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


@lru_cache(maxsize=1)
def _bin_ranks(bins: int) -> np.ndarray:
    """For each bin, the order in which it asks the others when it is empty."""
    order = np.argsort(wb.mix(np.arange(bins * bins, dtype=np.uint64) + wb.U(77)).reshape(bins, bins), axis=1)
    ranks = np.empty((bins, bins), dtype=np.int32)
    np.put_along_axis(ranks, order, np.broadcast_to(np.arange(bins, dtype=np.int32), (bins, bins)), axis=1)
    return ranks


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Densified one-permutation MinHash of a sorted set of 64-bit hashes.

    The top bits choose the bin, so in sorted order a bin's minimum is its first
    entry.  An empty bin copies the first non-empty one in its own fixed order.
    """
    edges = (np.arange(bins + 1, dtype=np.float64) * (2.0**64 / bins)).astype(np.float64)
    at = np.searchsorted(shingles, np.minimum(edges[:-1], 2.0**64 - 2049).astype(np.uint64))
    stop = np.append(at[1:], len(shingles))
    full = np.flatnonzero(stop > at)
    out = np.empty(bins, dtype=np.uint64)
    out[full] = shingles[at[full]]
    empty = np.flatnonzero(stop <= at)
    if len(empty):
        out[empty] = out[full[_bin_ranks(bins)[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(bands, rows)
    h = wb.mix(np.arange(1, bands + 1, dtype=np.uint64))
    for j in range(rows):
        h = wb.mix(h * wb.U(0x9E3779B97F4A7C15) + parts[:, j])
    return h


def shingle_sets(batch, fold: bool = True, k: int = SHINGLE):
    """Yield (row, sorted distinct shingle hashes) for the texts of a batch."""
    data, offsets = wb.utf8(batch.column(batch.schema.get_field_index("text")))
    words = wb.split_words(data, offsets, fold)
    hashes = words.hashes()
    runs, at = wb.grams(hashes, words.first, k)
    count = np.diff(words.first)
    for i in range(batch.num_rows):
        if count[i] >= k:
            yield i, np.unique(runs[at[i] : at[i + 1]])
        elif count[i]:  # fewer words than a shingle: the whole sequence is one
            own = hashes[words.first[i] : words.first[i + 1]]
            yield i, wb.grams(own, np.array([0, len(own)]), len(own))[0] ^ wb.U(len(own))
        else:
            yield i, np.zeros(0, np.uint64)


def _sketch(bands: int, rows: int):
    def run(batches):
        for batch in wb.text_chunks(batches, "text"):
            ids, n, a, b, out = batch.column(0), [], [], [], []
            for _, s in shingle_sets(batch):
                n.append(len(s))
                a.append(int(np.bitwise_xor.reduce(wb.mix(s)).astype(np.int64)) if len(s) else 0)
                b.append(int(np.add.reduce(wb.mix(s ^ wb.U(0x5851F42D4C957F2D))).astype(np.int64)) if len(s) else 0)
                out.append(band_hashes(signature(s, bands * rows), bands, rows).astype(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return run


def _sets(batches):
    for batch in wb.text_chunks(batches, "text"):
        sets = [s.astype(np.int64) for _, s in shingle_sets(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def _confirmed(sets: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs(hub, doc_id) whose full shingle sets are similar enough."""
    own = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("hub_shingles"))
    both = F.size(F.array_intersect("shingles", "hub_shingles")).cast("long")
    either = F.size("shingles") + F.size("hub_shingles") - both
    met = pairs.join(sets, "doc_id").join(own, "hub")
    # no distinct here: it would tie the join to the hub's partition, however hot
    return cut(met.where(100 * both >= percent * either).select("hub", "doc_id"), name)


def _apart(percent: int):
    """Links between different components within each tile of a bucket.

    Every pair of different components has a member outside the tile's most
    frequent one, so those members are held against all, in strips of rows: what
    is in memory is the tile's sets, a strip's counts and a block of shingles.
    """

    def run(batches):
        for (_, a, b), group in group_rows(batches, ["band", "a", "b"]):
            group = group.sort_by("doc_id")
            ids, component, mine = (group.column(k).to_numpy() for k in ("doc_id", "component", "mine"))
            lists = group.column("shingles").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            _, shingle, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
            owner = np.repeat(np.arange(len(ids)), size)
            often = times[shingle] > 1
            owner, shingle = owner[often], (np.cumsum(times > 1) - 1)[shingle[often]]
            order = np.argsort(shingle, kind="stable")  # a block of shingles is a slice
            owner, shingle = owner[order], shingle[order]
            kinds, n = np.unique(component, return_counts=True)
            most = kinds[n.argmax()]
            rows = np.flatnonzero(component != most)
            total, width = int(shingle.max(initial=-1)) + 1, max(1, BLOCK_CELLS // len(ids))
            for strip in np.array_split(rows, -(-len(rows) // STRIP)) if len(rows) else ():
                both = np.zeros((len(strip), len(ids)), dtype=np.float32)
                for start in range(0, total, width):
                    part = slice(*np.searchsorted(shingle, (start, start + width)))
                    who, what = owner[part], shingle[part] - start
                    grid = np.zeros((len(ids), min(width, total - start)), dtype=np.float32)
                    grid[who, what] = 1
                    both += grid[strip] @ grid.T
                both = both.astype(np.int64)
                either = size[strip, None] + size[None, :] - both
                ask = (100 * both >= percent * either) & (both > 0) & (component[strip, None] != component[None, :])
                ask &= (component == most)[None, :] | (component[strip, None] < component[None, :])
                if a != b:
                    ask &= mine[strip, None] != mine[None, :]
                x, y = np.nonzero(ask)
                x = strip[x]
                _, one = np.unique(np.stack([component[x], component[y]]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[x[one]]), pa.array(ids[y[one]])], names=["hub", "doc_id"])

    return run


def _meeting(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """doc_id: those of members(doc_id, component) that can be similar enough to
    one of another component.

    Shingles are ordered by how many members have them.  Of similar sets, the
    smaller one's rarest n - 2t/(1+t) n + 1 and the larger one's rarest
    n - t n + 1 must meet; a shingle that very many unlike members share (a
    template's) is beyond the former.
    """
    t = percent / 100
    rows = members.join(sets, "doc_id").select("doc_id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    single = cut(rows, "minhash-members")
    often = cut(single.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"), "minhash-often")
    ranked = (
        single.join(often, "shingle")
        .groupBy("doc_id", "component", "n")
        .agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("ranked"))
    )
    alone = F.col("n") - F.size("ranked")  # shingles of its own are the rarest
    room = F.col("n") - F.ceil(F.col("n") * t - 1e-9).cast("int") + 1 - alone
    short = F.col("n") - F.ceil(F.col("n") * (2 * t / (1 + t)) - 1e-9).cast("int") + 1 - alone
    lead = F.slice("ranked", F.lit(1), F.greatest(room, F.lit(0)))
    spots = ranked.select("doc_id", "component", short.alias("short"), F.posexplode(lead).alias("place", "at"))
    spots = spots.select("doc_id", "component", (F.col("place") < F.col("short")).alias("small"), F.col("at.shingle").alias("shingle"))
    spots = cut(spots, "minhash-prefixes")
    met = spots.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("small").alias("small"))
    met = cut(met.where("low < high and small").select("shingle"), "minhash-met")
    return cut(spots.join(met, "shingle").select("doc_id").distinct(), "minhash-meeting")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the links between components."""

    def of(column):
        known = labels.select(F.col("node").alias(column), F.col("component").alias(f"{column}_c"))
        return known, F.coalesce(f"{column}_c", column)

    hub, a = of("hub")
    doc, b = of("doc_id")
    between = components(links.join(hub, "hub", "left").join(doc, "doc_id", "left").select(a.alias("a"), b.alias("b")), "minhash-merge")
    old = labels.union(  # a node that had no label so far was its own component
        between.select("node", F.col("node").alias("component")).join(labels.select("node"), "node", "left_anti")
    )
    step = between.select(F.col("node").alias("component"), F.col("component").alias("lower"))
    return old.join(step, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 75, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """Group documents whose five-word shingle sets have Jaccard >= percent/100.

    Returns one row per doc_id: n_shingles (size of the set), component_id (the
    smallest doc_id reachable over confirmed links, itself included) and kept
    (doc_id = component_id).

    Words are runs of bytes other than space and \\t..\\r, A-Z lower-cased.  A
    null or empty text has no shingles and is linked with nothing; a text of one
    to four words is one shingle.  Equal sets form one class that is compared
    once, through its smallest doc_id.  Rows that repeat a doc_id are one
    document: it has the links of all of them and the largest n_shingles.  Rows
    without a doc_id are left out; further columns are ignored.

    At 0.75 a pair escapes all 48 bands of 6 with probability 1e-4.  A bucket
    whose star leaves its members in several components is looked at again: the
    members' sets are held against those of the other components, in tiles of
    bounded size, and just the links found come out.  Of buckets of several
    tiles only the members that share a rare shingle with another component take
    part (see _meeting); no other can have a link.  So a bucket loses no link
    between components to the choice of its hub.
    """
    docs = texts(docs).where("doc_id is not null")
    sketch = cut(docs.mapInArrow(_sketch(bands, band_rows), SKETCH), "minhash-sketch")
    classes = (
        sketch.where("n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
        .where("rep < last")
        .drop("last")
    )
    classes = cut(classes, "minhash-classes")
    member = sketch.join(classes, ["set_a", "set_b", "n_shingles"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))

    entries = member.where("rep = doc_id").select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    hubs = (
        entries.groupBy("band")
        .agg(F.min(F.struct("doc_id", "n_shingles")).alias("hub"), F.max("doc_id").alias("last"))
        .where("hub.doc_id < last")
        .select("band", F.col("hub.doc_id").alias("hub"), F.col("hub.n_shingles").alias("hub_n"))
    )
    hubs = cut(hubs, "minhash-hubs")
    shared = cut(entries.join(hubs, "band"), "minhash-shared")
    # the list of ids grows with the documents, so it is never broadcast to them
    members = shared.select("doc_id").union(hubs.select(F.col("hub").alias("doc_id"))).distinct()
    sets = cut(
        docs.join(members.hint("merge"), "doc_id").select("doc_id", "text").mapInArrow(_sets, "doc_id long, shingles array<long>"),
        "minhash-sets",
    )

    def near_size(x, y):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    stars = shared.where((F.col("doc_id") > F.col("hub")) & near_size("n_shingles", "hub_n")).select("hub", "doc_id").distinct()
    links = _confirmed(sets, stars, percent, "minhash-links")
    labels = components(links.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")), "minhash")

    placed = shared.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")
    )
    placed = cut(placed, "minhash-placed")
    mixed = (
        placed.groupBy("band")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("size"),
            F.sum("n_shingles").alias("shingles"),
            F.bit_xor(F.xxhash64("doc_id")).alias("who"),
        )
        .where("low < high")
        .groupBy("size", "who")  # buckets of the same documents are compared once
        .agg(F.min("band").alias("band"), F.max("shingles").alias("shingles"))
        .select("band", F.ceil(F.greatest(F.col("size") / TILE_DOCUMENTS, F.col("shingles") / TILE_SHINGLES)).cast("int").alias("tiles"))
    )
    mixed = cut(mixed, "minhash-mixed")
    spread, large = placed.join(mixed.where("tiles = 1"), "band"), mixed.where("tiles > 1")
    if not large.isEmpty():
        large = cut(placed.join(large, "band"), "minhash-large")
        meeting = _meeting(large.select("doc_id", "component").distinct(), sets, percent)
        spread = spread.union(large.join(meeting, "doc_id", "left_semi").select(*spread.columns))
    mine = F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")
    spread = (
        spread.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("band", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "doc_id", "component")
    )
    keys = ["band", "a", "b"]
    late = (
        spread.join(sets, "doc_id")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_apart(percent), "hub long, doc_id long")
    )
    late = cut(late.distinct(), "minhash-late")
    if not late.isEmpty():
        labels = cut(_merged(labels, late), "minhash-labels")

    labels = labels.select(F.col("node").alias("rep"), "component")
    return (
        member.select("doc_id", "n_shingles", "rep")
        .join(labels, "rep", "left")
        .groupBy("doc_id")
        .agg(F.max("n_shingles").alias("n_shingles"), F.min(F.coalesce("component", "rep")).alias("component_id"))
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of docs for each group of near duplicates (see near_duplicates).

    Every row is a document of its own, told apart by doc_id and text: a doc_id
    that is null or stands on several texts joins nothing.  The row of a group's
    smallest doc_id stays (without doc_id last; on a tie, of its texts the one of
    smallest hash).  Of rows repeated in doc_id and text one stays; which, if
    their other columns differ, is open.  Rows whose text is null, empty or has
    no words are linked with nothing and all stay.  Columns come back as they are.
    """
    own = spare(docs.columns, "_row")
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(key.alias("node"), "doc_id")
    groups = cut(near_duplicates(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("node"), "n_shingles", "component_id"), "minhash-groups")
    told = groups.where("n_shingles > 0").join(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "node")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    best = told.groupBy("component_id").agg(F.min_by("node", order).alias("stays"), F.count("*").alias("members"), F.max("copies").alias("most"))
    # only groups with something to drop take part from here on
    shared = told.join(best.where("members > 1 or most > 1"), "component_id")
    shared = cut(shared.select(F.col("node").alias(own), (F.col("node") == F.col("stays")).alias("stays"), "copies"), "minhash-shared-rows")
    keyed = docs.withColumn(own, key)
    single = keyed.join(shared.where("not stays or copies > 1"), own, "left_anti")
    several = keyed.join(shared.where("stays and copies > 1"), own, "left_semi").dropDuplicates([own])
    return single.unionByName(several).select(*docs.columns)


def op9_minhash(spark, sf_dir):
    from folio.llm.common import documents

    return near_duplicates(documents(spark, sf_dir))
