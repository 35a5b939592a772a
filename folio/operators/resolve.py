"""Entity resolution: from mentions to canonical entities."""

from __future__ import annotations

import difflib
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Organisation suffixes and their short forms.
SUFFIXES = {"corporation": "corp", "company": "co", "incorporated": "inc", "limited": "ltd", "international": "intl", "association": "assoc"}


def keep_best(mentions: DataFrame, keys=("name", "entity_type"), confidence: str = "confidence") -> DataFrame:
    """One row per lower-cased text and type: the most confident mention."""
    rows = mentions.withColumn("name", F.lower("entity_text"))
    rest = [confidence, *sorted(c for c in rows.columns if c not in (*keys, confidence))]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"), F.count("*").alias("mention_count"))
    return best.select(*keys, "_best.*", "mention_count")


def contained_names(names: DataFrame, shortest: int) -> DataFrame:
    """Pairs of one type where one name contains the other (similarity 95).

    Blocked by character grams: a name of n >= shortest characters is looked up
    by its first `shortest` characters among all grams of that size.
    """
    inner = names.where(F.length("name") >= shortest).select(
        "entity_type", F.col("canonical_id").alias("source_id"), F.col("name").alias("inner_name"), F.substring("name", 1, shortest).alias("gram"))
    spots = F.sequence(F.lit(1), F.length("name") - shortest + 1)
    outer = names.where(F.length("name") >= shortest).select(
        "entity_type", F.col("canonical_id").alias("target_id"), F.col("name").alias("outer_name"),
        F.explode(F.array_distinct(F.transform(spots, lambda i: F.substring(F.col("name"), i, F.lit(shortest))))).alias("gram"))
    pairs = inner.join(outer, ["entity_type", "gram"]).where((F.col("source_id") != F.col("target_id")) & F.col("outer_name").contains(F.col("inner_name")))
    return pairs.select("source_id", "target_id", F.lit(95).alias("similarity"))


#: Keys of one name at most, and long names of one part of a gram's names.
KEYS = 1024
PART = 2048


def _room(length, percent: int):
    """How many edits names may differ by, the longer one having this length."""
    return length * (100 - percent) // 100


def _longest(length, percent: int):
    """The length of the longest name that one of this length can be similar to."""
    return length * 100 // percent


def _shortened(percent: int, edge: int):
    """Rows (entity_type, canonical_id, name) with a key for each way to shorten the
    name as in a pair whose longer name has fewer than edge letters.

    Two names of lengths n and n - gone within d edits keep n - d letters in common,
    in order, so they are equal once d letters of the one and d - gone of the other
    are left out.  A key is the hash of what is left, of type and n.
    """

    def work(batches):
        for batch in batches:
            kinds, names = batch.column("entity_type").to_pylist(), batch.column("name").to_pylist()
            by_length: dict[int, list[int]] = {}
            for i, name in enumerate(names):
                by_length.setdefault(len(name), []).append(i)
            for n, rows in by_length.items():
                letters = np.array([[ord(c) for c in names[i]] for i in rows], np.uint64).reshape(len(rows), n)
                seeds = np.array([zlib.crc32(kinds[i].encode()) for i in rows], np.uint64)[:, None] << np.uint64(32)
                for length in range(n, min(_longest(n, percent) + 1, edge)):
                    kept = length - _room(length, percent)
                    picks = list(itertools.combinations(range(n), kept))
                    picks = np.array(picks, int).reshape(len(picks), kept)
                    step = max(1, (1 << 18) // len(picks))
                    for at in range(0, len(rows), step):
                        some = letters[at : at + step]
                        keys = np.repeat(seeds[at : at + step] + np.uint64(length), len(picks), axis=1)
                        for place in picks.T:
                            keys = (keys + some[:, place]) * np.uint64(0x9E3779B97F4A7C15)
                            keys ^= keys >> np.uint64(29)
                        keys.sort(axis=1)
                        new = np.ones(keys.shape, bool)
                        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                        mine = batch.take(pa.array(np.array(rows[at : at + step])[np.nonzero(new)[0]]))
                        yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(keys[new].view(np.int64)), pa.array(np.full(len(mine), length - n, np.int32))], names=[*mine.schema.names, "key", "gone"])

    return work


def _grams(percent: int, edge: int, gram: int):
    """Rows (entity_type, canonical_id, name) with each gram of a name that can be
    similar to one of edge letters or more, and the parity of each letter's count as
    64 bits (letters share bits), which an edit changes in two places at most."""

    def work(batches):
        for batch in batches:
            place, grams, parity = [], [], []
            for i, name in enumerate(batch.column("name").to_pylist()):
                if _longest(len(name), percent) < edge:
                    continue
                bits = 0
                for c in name:
                    bits ^= 1 << ord(c) % 64
                padded = f"^{name}$"
                found = {padded[j : j + gram] for j in range(len(padded) - gram + 1)}
                place += [i] * len(found)
                grams += found
                parity += [bits - (1 << 64) if bits >> 63 else bits] * len(found)
            mine = batch.take(pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(grams, pa.string()), pa.array(parity, pa.int64())], names=[*mine.schema.names, "gram", "parity"])

    return work


def similar_names(names: DataFrame, percent: int = 80, gram: int = 3) -> DataFrame:
    """Pairs of one type whose names are within an edit distance of 100 - percent
    hundredths of the longer name.

    Names meet where they are equal once as many letters are left out as they may
    differ by, in each way there is (see _shortened): hardly more pairs than are
    similar.  From the length on where that makes over KEYS ways, d edits destroy at
    most d * gram grams, and candidates come from an equi-join on the rarest grams
    that this bound leaves room for, those of a frequent gram in parts that meet each
    other; they are told apart by their letters' parities first.  All are verified.
    """
    edge = next((n for n in range(1, 1000) if math.comb(n, _room(n, percent)) > KEYS), 1000)
    gram = max(1, min(gram, 99 // max(100 - percent, 1)))  # so few that some gram stays
    names = names.select("entity_type", "canonical_id", "name").where("entity_type is not null and canonical_id is not null and name is not null")
    names = names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "canonical_id")  # few bytes, many keys
    longer = F.greatest(F.length("name1"), F.length("name2"))
    room = F.floor(longer * (100 - percent) / 100).cast("int")
    schema = f"entity_type string, canonical_id {names.schema['canonical_id'].dataType.simpleString()}, name string"

    # a name with those before it that have its key, of which one at least is a longer one
    keyed = names.mapInArrow(_shortened(percent, edge), f"{schema}, key long, gone int")
    before = Window.partitionBy("key", "entity_type").orderBy("gone", "canonical_id").rowsBetween(Window.unboundedPreceding, -1)
    others = F.collect_list(F.when(F.col("gone") == 0, F.struct(F.col("canonical_id").alias("canonical_id1"), F.col("name").alias("name1")))).over(before)
    short = keyed.select("entity_type", F.col("canonical_id").alias("canonical_id2"), F.col("name").alias("name2"), others.alias("others")).select("entity_type", "canonical_id2", "name2", F.inline("others"))

    rows = names.mapInArrow(_grams(percent, edge, gram), f"{schema}, gram string, parity long")
    often = rows.groupBy("entity_type", "gram").agg(F.count("*").alias("often"))
    # a bit for each of the most frequent grams: where both names have one before, they have met there
    top = often.orderBy(F.desc("often"), "entity_type", "gram").limit(63).agg(F.array_sort(F.collect_list(F.struct("entity_type", "gram"))).alias("top"))
    bits = top.select(F.posexplode("top").alias("bit", "g")).select("g.*", F.expr("shiftleft(1L, bit)").alias("bit"))
    order = Window.partitionBy("entity_type", "canonical_id", "name").orderBy("often", "gram")
    met = F.coalesce(F.sum("bit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("met")
    most = F.floor(F.length("name") * (100 - percent) / percent) * gram + 1
    parts = F.ceil(F.col("often") / PART).cast("int")
    lead = rows.join(often, ["entity_type", "gram"]).join(F.broadcast(bits), ["entity_type", "gram"], "left").select(
        *rows.columns, met, F.row_number().over(order).alias("rank"), parts.alias("parts"), F.pmod(F.xxhash64("canonical_id", "name"), parts).cast("int").alias("own")).where(F.col("rank") <= most)
    side = lambda end: [F.col(c).alias(c + end) for c in ("canonical_id", "name", "parity", "met")]
    low = lead.select("entity_type", "gram", F.col("own").alias("low"), F.explode(F.sequence("own", F.col("parts") - 1)).alias("high"), *side("1"))
    high = lead.select("entity_type", "gram", F.explode(F.sequence(F.lit(0), "own")).alias("low"), F.col("own").alias("high"), *side("2"))
    long = low.hint("merge").join(high, ["entity_type", "gram", "low", "high"]).where((F.col("low") < F.col("high")) | (F.col("canonical_id1") < F.col("canonical_id2")))
    apart = F.bit_count(F.col("parity1").bitwiseXOR(F.col("parity2"))) > 2 * room

    def verified(pairs: DataFrame, may: Column) -> DataFrame:
        turned = F.col("canonical_id1") > F.col("canonical_id2")
        pick = lambda c, one, two: F.when(turned, F.col(c + two)).otherwise(F.col(c + one)).alias(c + one)
        distance = F.when(may, F.call_function("levenshtein", "name1", "name2", room).cast("long"))  # in this order, as where() keeps none
        near = pairs.withColumn("distance", distance).where("distance >= 0")
        both = [pick(c, one, two) for c in ("canonical_id", "name") for one, two in ("12", "21")]
        return near.select("entity_type", *both, "distance").distinct()

    found = verified(short, F.col("canonical_id1") != F.col("canonical_id2")).unionByName(
        verified(long, (F.col("met1").bitwiseAND(F.col("met2")) == 0) & (F.col("canonical_id1") != F.col("canonical_id2")) & (longer >= edge) & ~apart))
    return found.select("entity_type", F.col("canonical_id1").alias("source_id"), F.col("canonical_id2").alias("target_id"), "distance")


def _digits(text: str) -> str:
    return "".join(ch for ch in text if ch.isdigit())


def _person(text: str) -> tuple[str, str]:
    if "," in text:
        last, _, first = text.partition(",")
        return last.strip(), first.strip()
    parts = text.split()
    return (parts[-1], parts[0]) if parts else ("", "")


def _org(text: str) -> str:
    words = "".join(ch for ch in text if ch.isalnum() or ch == " ").split()
    return " ".join(SUFFIXES.get(w, w) for w in words)


def same_entity(a: str, b: str, kind: str) -> bool:
    """Variation rules on lower-cased names: containment, initials, digits."""
    if a == b or a in b or b in a:
        return True
    if kind == "PERSON":
        (last, first), (last2, first2) = _person(a), _person(b)
        return bool(first and first2) and last == last2 and first[0] == first2[0]
    if kind == "ORG":
        x, y = _org(a), _org(b)
        initials = lambda t: "".join(w[0] for w in t.split())
        return x == y or x.replace(" ", "") == initials(y) or y.replace(" ", "") == initials(x)
    if kind == "DATE":
        return bool(_digits(a)) and _digits(a) == _digits(b)
    return False


def _letters(names: list[str]) -> np.ndarray:
    """How often each letter stands in each name, in columns by letter."""
    letters = {c: i for i, c in enumerate(sorted(set("".join(names))))}
    out = np.zeros((len(names), max(len(letters), 1)), dtype=np.int16)
    for row, name in zip(out, names):
        for c in name:
            row[letters[c]] += 1
    return out


def _groups(names: list[str], kind: str, threshold: float, rules: bool) -> list[int]:
    """The group (number of its seed) of each name, greedily.

    Letters in common bound both the ratio and containment, so just the names
    that can be alike are compared in full.
    """
    low = [n.lower().strip() for n in names]
    if len(low) == 1:
        return [0]
    letters, size = _letters(low), np.array([len(n) for n in low])
    initials = [_person(n) for n in low] if rules and kind == "PERSON" else []
    person = np.array([hash((last, first[:1])) if first else i for i, (last, first) in enumerate(initials)])
    group = np.full(len(low), -1)
    for i, seed in enumerate(low):
        if group[i] >= 0:
            continue
        group[i] = i
        rest = i + 1 + np.flatnonzero(group[i + 1 :] < 0)
        if not len(rest):
            break
        common = np.minimum(letters[rest], letters[i]).sum(axis=1)
        may = 2 * common >= threshold * (size[rest] + size[i]) - 1e-9
        if rules:
            may |= common == np.minimum(size[rest], size[i])  # one can be contained
            may |= (person[rest] == person[i]) if len(person) else kind in ("ORG", "DATE")
        matcher = difflib.SequenceMatcher()
        matcher.set_seq2(seed)
        for j in rest[may].tolist():
            matcher.set_seq1(low[j])
            if matcher.ratio() >= threshold or (rules and same_entity(seed, low[j], kind)):
                group[j] = i
    return group.tolist()


def resolve_greedy(mentions: DataFrame, threshold: float = 0.8, rules: bool = True) -> DataFrame:
    """Greedy clusters of the mentions of each document and type.

    Names are taken in order of first appearance (chunk, ordinal); each that is
    still free seeds a group and draws in later ones that are alike, or (with
    rules) are variations of it.  A group is named by its longest text, the
    first of these; group_size counts its mentions.  Distinct names are compared
    once and joined back by the caller.  Confidence is 1 for a single mention and
    0.8 for more; without rules always 0.7.  Returns document_id, entity_type,
    entity_text, canonical_name, group_size, confidence, resolution_method.
    """
    first = F.min(F.struct("chunk_index", "ordinal")).alias("first")
    names = mentions.groupBy("document_id", "entity_type", "entity_text").agg(first, F.count("*").alias("n"))
    keys = ["document_id", "entity_type"]
    names = names.repartition(*keys).sortWithinPartitions(*keys, "first", "entity_text").select(*keys, "entity_text", "n")

    def walk(document, kind, texts, counts):
        group = _groups(list(texts), kind, threshold, rules)
        chosen: dict[int, str] = {}
        size: dict[int, int] = {}
        for name, g, n in zip(texts, group, counts):
            size[g] = size.get(g, 0) + n
            if g not in chosen or len(name) > len(chosen[g]):
                chosen[g] = name
        return [(document, kind, name, chosen[g], size[g]) for name, g in zip(texts, group)]

    grouped = _by_document(names, walk, "document_id long, entity_type string, entity_text string, canonical_name string, group_size long")
    confidence = F.when(F.col("group_size") == 1, 1.0).otherwise(0.8) if rules else F.lit(0.7)
    return grouped.withColumns({"confidence": confidence, "resolution_method": F.when(confidence < 0.9, "fuzzy").otherwise("llm")})


def _by_document(names: DataFrame, walk, schema: str) -> DataFrame:
    """What walk(document, type, *columns) gives for each document and type, of
    rows sorted by these two."""
    out = [field.split()[0] for field in schema.split(", ")]

    def work(batches):
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        held = []
        for (document, kind), members in itertools.groupby(rows, key=lambda row: row[:2]):
            held += walk(document, kind, *list(zip(*members))[2:])
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=out)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=out)

    return names.mapInArrow(work, schema)


def name_likeness(a: str, b: str) -> float:
    """1 if equal, 0.9 if one holds the other, else the larger of matching ratio
    and 0.8 of the words in common."""
    a, b = a.lower().strip(), b.lower().strip()
    if a == b:
        return 1.0
    if a in b or b in a:
        return 0.9
    words, words2 = set(a.split()), set(b.split())
    shared = len(words & words2) / max(len(words), len(words2), 1)
    return max(difflib.SequenceMatcher(None, a, b).ratio(), 0.8 * shared)


def _hybrid_groups(names: list[str], vectors: list, threshold: float, weight: float) -> list[int]:
    """The group of each name, greedily; names are compared letter by letter just
    where vectors, or letters in common, leave room for the threshold."""
    known = np.array([v is not None for v in vectors])
    unit = np.zeros((len(names), max((len(v) for v in vectors if v is not None), default=1)))
    for row, v in zip(unit, vectors):
        if v is not None:
            row[:] = v
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    low = [n.lower().strip() for n in names]
    letters, size = _letters(low), np.array([len(n) for n in low])
    several = np.array([len(n.split()) > 1 for n in low])
    group = np.full(len(low), -1)
    for i in range(len(low)):
        if group[i] >= 0:
            continue
        group[i] = i
        rest = i + 1 + np.flatnonzero(group[i + 1 :] < 0)
        if not len(rest):
            break
        near, both = unit[rest] @ unit[i], known[rest] & known[i]
        common = np.minimum(letters[rest], letters[i]).sum(axis=1)
        alike = (2 * common >= threshold * (size[rest] + size[i]) - 1e-9) | (common == np.minimum(size[rest], size[i])) | (several[rest] & several[i])
        may = np.where(both, weight * near + 1 - weight >= threshold - 1e-9, alike)
        for j, cosine_, vector in zip(rest[may].tolist(), near[may], both[may]):
            letters_ = name_likeness(names[i], names[j])
            if (weight * cosine_ + (1 - weight) * letters_ if vector else letters_) >= threshold:
                group[j] = i
    return group.tolist()


def resolve_hybrid(mentions: DataFrame, threshold: float = 0.75, weight: float = 0.7) -> DataFrame:
    """Greedy clusters by `weight` cosine and the rest name likeness, by likeness
    alone where one of two names has no vector.

    mentions has document_id, entity_type, chunk_index, ordinal, entity_text and
    embedding (null if unknown; one vector for a name in a document).  Names are
    taken in order of first appearance.  A group is named by its longest text, a
    PERSON by the one of most words; confidence is the mentions' mean likeness to
    that name, at least 0.8, or 0.95 for several mentions.  Returns document_id,
    entity_type, entity_text, canonical_name, group_size, confidence.
    """
    keys = ["document_id", "entity_type"]
    first = F.min(F.struct("chunk_index", "ordinal")).alias("first")
    names = mentions.groupBy(*keys, "entity_text").agg(first, F.count("*").alias("n"), F.first("embedding", ignorenulls=True).alias("embedding"))
    names = names.repartition(*keys).sortWithinPartitions(*keys, "first", "entity_text").select(*keys, "entity_text", "n", "embedding")

    def walk(document, kind, texts, counts, vectors):
        out = []
        group = np.array(_hybrid_groups(list(texts), list(vectors), threshold, weight))
        for seed in np.unique(group):
            members = np.flatnonzero(group == seed).tolist()
            chosen = max((texts[i] for i in members), key=len)
            if kind == "PERSON":
                chosen = max([chosen, *(texts[i] for i in members)], key=lambda name: len(name.split()))
            size = sum(counts[i] for i in members)
            likeness = sum(counts[i] * name_likeness(texts[i], chosen) for i in members) / size
            confidence = max(0.95 if size > 1 else 0.8, likeness)
            out += [(document, kind, texts[i], chosen, size, round(confidence, 6)) for i in members]
        return out

    return _by_document(names, walk, "document_id long, entity_type string, entity_text string, canonical_name string, group_size long, confidence double")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 if either is null or all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when(norm > 0, dot(a, b) / norm), F.lit(0.0))


def merge_canonicals(mentions: DataFrame, merges: DataFrame) -> DataFrame:
    """mentions with canonical_id repointed by merges(merge_id, keep_id)."""
    step = merges.select(F.col("merge_id").alias("canonical_id"), "keep_id")
    return mentions.join(step, "canonical_id", "left").withColumn("canonical_id", F.coalesce("keep_id", "canonical_id")).drop("keep_id")


def apply_groupings(responses: DataFrame, response: str) -> DataFrame:
    """document_id, entity_text, canonical_name from {canonical: [names]} JSON."""
    groups = F.from_json(response, "map<string, array<string>>")
    rows = responses.select("document_id", F.explode(groups).alias("canonical_name", "members"))
    return rows.select("document_id", F.explode("members").alias("entity_text"), "canonical_name")
