"""Cross-tokenizer alignment over Arrow tables (operator 13).

Texts are encoded by a byte-level BPE (A) and by a piece model (B).  Both cover
the same bytes, so tokens are aligned by where they end: the lists of tokens are
flattened, byte lengths are summed up within each document, and an Acero join on
(document, end) brings the ends together.  Where both end, a group ends; every
end of either one closes the overlap of just one A and one B token, a link.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, texts

#: Where the tokenizers are; the driver reads them and sends them along.
BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text that are aligned at a time, and whose link counts become one row.
ALIGN_BYTES, COUNT_BYTES = 1 << 20, 16 << 20
#: Bits of a byte offset within a document; its number in the batch is above them.
END_BITS = 40
#: Most id pairs whose counts are broadcast (16 bytes each); the others are joined.
FREQUENT = 1 << 17

#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters outside blocks whose classes all Unicode versions of use agree on.
_UNSETTLED = re.compile(r"[^\u0000-\u052f\u2000-\u206f\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")

#: A word with the spaces before it, or the spaces at the end.
_SPACED = re.compile(" *[^ ]+| +")
#: Words whose pieces a task remembers at most, and their length.
REMEMBERED, REMEMBERED_CHARS = 300_000, 40

ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>, counts array<long>"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_level(model: str):
    """(texts to token ids, the bytes of each id) of a byte-level BPE in JSON.

    Where ids follow the merges and the settings are the plain ones, merging by
    rank is the same and faster; texts with rare characters, which the two
    libraries might class differently, and other models go the long way.
    """
    from tokenizers import Tokenizer

    spec = json.loads(model)
    vocabulary, letters = spec["model"]["vocab"], byte_letters()
    whole = Tokenizer.from_str(model)
    whole.encode_special_tokens = True
    special = {x["content"] for x in spec["added_tokens"]}
    spelled = [b""] * (1 + max(vocabulary.values()))
    for token, i in vocabulary.items():
        spelled[i] = token.encode() if token in special else bytes(letters[c] for c in token)
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
    before = spec["pre_tokenizer"] or {}
    ranked = (
        all(vocabulary.get(m) == 256 + i for i, m in enumerate(merges)) and spec["normalizer"] is None and not spec["model"].get("ignore_merges")
        and (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)) == ("ByteLevel", False, True))
    if ranked:
        import tiktoken

        quick = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={spelled[i]: i for t, i in vocabulary.items() if t not in special}, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        if not ranked:
            return [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
        return [quick.encode_ordinary(x) if not _UNSETTLED.search(x) else whole.encode(x, add_special_tokens=False).ids for x in texts]

    return encode, pa.array(spelled, pa.binary())


@lru_cache(maxsize=2)
def piece_level(model: bytes):
    """(texts to piece ids, the bytes of each id) of a piece model.

    Where no piece has a space behind another character, no merge crosses from a
    word to the next space, so words with the spaces before them are encoded one
    by one, and each just once while it is remembered.
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    spelled, apart = [], True
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        apart &= "▁" not in piece.lstrip("▁")
        spelled.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    known: dict[str, list[int]] = {}
    lone = [pieces.piece_to_id("▁")]

    def encode(texts: list[str]) -> list[list[int]]:
        if not apart:
            return pieces.encode(texts, num_threads=1)
        words = [_SPACED.findall(" " + x) for x in texts]
        if len(known) > REMEMBERED:
            known.clear()
        known[" "] = lone  # at the end of a text
        new = [w for w in set().union(*words) if w not in known]
        known.update(zip(new, pieces.encode([w[1:] for w in new], num_threads=1)))  # the model puts a space before each
        out = [list(chain.from_iterable(map(known.__getitem__, own))) for own in words]
        for w in new:
            if len(w) > REMEMBERED_CHARS:
                del known[w]
        return out

    return encode, pa.array(spelled, pa.binary())


def token_ends(ids: pa.ListArray, spelled: pa.BinaryArray, name: str) -> tuple[pa.Table, pa.Array]:
    """(end, id) of every token, and all tokens' bytes: the lists are flattened,
    lengths are summed up, and what stood before a document is taken off.  An end
    is the document's number in the high bits and a byte offset in the low ones."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    tokens = spelled.take(flat)
    total = pc.cumulative_sum(pc.binary_length(tokens).cast(pa.int64()))
    first = np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()
    before = np.concatenate(([0], np.asarray(total)))[first]
    start = pa.array((np.arange(len(ids)) << END_BITS) - before)
    return pa.table({"end": pc.add(total, start.take(doc)), name: flat}), tokens


def spells(ids: pa.ListArray, tokens: pa.BinaryArray, expected: list[bytes]) -> np.ndarray:
    """Which documents' tokens join to the expected bytes."""
    _, offsets, data = tokens.buffers()
    at = np.frombuffer(offsets, np.int32)[tokens.offset + np.asarray(ids.offsets) - ids.offsets[0].as_py()] if offsets else np.zeros(len(expected) + 1, int)
    data = data.to_pybytes() if data else b""
    return np.array([data[at[i] : at[i + 1]] == x for i, x in enumerate(expected)], dtype=bool)


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """doc, a, b in order, a row for each overlap of an A and a B token, with
    a_ends and b_ends: whether the token ends there too."""
    met = a.join(b, keys="end", join_type="full outer", use_threads=False).combine_chunks()
    met = met.take(pc.sort_indices(met["end"]))
    return pa.table({
        "doc": pc.shift_right(met["end"], END_BITS), "a": pc.fill_null_backward(met["a"]), "b": pc.fill_null_backward(met["b"]),
        "a_ends": pc.is_valid(met["a"]), "b_ends": pc.is_valid(met["b"])})


def group_texts(found: pa.Table, n: int, digits: pa.StringArray) -> tuple[np.ndarray, pa.Array]:
    """Each of n documents' number of groups, and these as `a1,a2|b1;a3|b2,b3`."""
    closes = np.asarray(pc.and_(found["a_ends"], found["b_ends"]))
    group = np.cumsum(closes) - closes
    groups = np.bincount(np.asarray(found["doc"])[closes], minlength=n)
    sides = []
    for side in ("a", "b"):
        here = np.asarray(found[f"{side}_ends"])
        size = np.bincount(group[here], minlength=int(closes.sum()))
        told = digits.take(found[side].combine_chunks().filter(pa.array(here)))
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), told), ","))
    both = pc.binary_join_element_wise(*sides, "|")
    return groups, pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(groups))), pa.int32()), both), ";")


def _lists(values, counts) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, pa.int32()))


def _align(models):
    """A task over (doc_id, text): rows of documents with their id pairs, and rows
    (without row) of counts of pairs over at most COUNT_BYTES of text."""

    def run(batches):
        encode_a, spelled_a = byte_level(models.value[0])
        encode_b, spelled_b = piece_level(models.value[1])
        width = len(spelled_b)
        if len(spelled_a) * width >= 1 << 31:
            raise ValueError("the vocabularies' pairs don't fit in 31 bits")
        digits = pa.array([str(i) for i in range(max(len(spelled_a), width))])
        row, held, size = TaskContext.get().partitionId() << 33, [], 0

        def counted():
            total = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("times", "sum")])
            nulls = [pa.nulls(1, f.type) for f in _SCHEMA]
            lists = {"pairs": total["pair"].combine_chunks(), "counts": total["times_sum"].combine_chunks()}
            for k, v in lists.items():
                nulls[_SCHEMA.get_field_index(k)] = pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(_SCHEMA.field(k).type.value_type))
            return pa.RecordBatch.from_arrays(nulls, schema=_SCHEMA)

        for batch in wb.text_chunks(batches, "text", ALIGN_BYTES):
            given = batch.column(1).to_pylist()
            full = [i for i, x in enumerate(given) if x]
            spaced = [" " + given[i] for i in full]
            a, b = (pa.array(f(some), pa.list_(pa.int32())) for f, some in ((encode_a, spaced), (encode_b, [x[1:] for x in spaced])))
            (ends_a, tokens_a), (ends_b, tokens_b) = token_ends(a, spelled_a, "a"), token_ends(b, spelled_b, "b")
            raw = [x.encode() for x in spaced]
            good = spells(a, tokens_a, raw) & spells(b, tokens_b, raw)
            if not good.all():
                keep = pa.array(good)
                (ends_a, _), (ends_b, _) = token_ends(a.filter(keep), spelled_a, "a"), token_ends(b.filter(keep), spelled_b, "b")
            place = np.asarray(full, np.int64)[good]  # of the aligned documents in the batch
            n = len(place)
            found = links(ends_a, ends_b)
            groups, told = group_texts(found, n, digits)
            doc = np.asarray(found["doc"])
            pair = np.asarray(found["a"], dtype=np.int64) * width + np.asarray(found["b"])
            own = pa.table({"key": (doc << 31) + pair}).group_by("key", use_threads=False).aggregate([([], "count_all")]).sort_by("key").combine_chunks()
            key = own["key"].to_numpy()
            own = pa.table({"doc": key >> 31, "pair": (key & (1 << 31) - 1).astype(np.int32), "times": own["count_all"]})
            held.append(own.select(["pair", "times"]).group_by("pair", use_threads=False).aggregate([("times", "sum")]).rename_columns(["pair", "times"]))

            def spread(values):
                out = np.zeros(batch.num_rows, np.int64)
                out[place] = values
                return out

            digest = [""] * batch.num_rows
            for i, x in zip(place.tolist(), told.to_pylist()):
                digest[i] = hashlib.sha256(x.encode()).hexdigest()
            kept = spread(np.bincount(np.asarray(own["doc"]), minlength=n))
            tokens = [spread(np.bincount(np.asarray(e["end"]) >> END_BITS, minlength=n)) for e in (ends_a, ends_b)]
            columns = [
                np.arange(row, row + batch.num_rows), batch.column(0), *tokens,
                spread(groups), spread(np.bincount(doc, minlength=n)), digest, _lists(np.asarray(own["pair"]), kept), _lists(np.asarray(own["times"]), kept), pa.nulls(batch.num_rows, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)
            row, size = row + batch.num_rows, size + sum(map(len, raw))
            if size >= COUNT_BYTES:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return run


_SCHEMA = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
     ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


def _known(frequent: pa.Table):
    """A task over document rows: sums over frequent pairs, and the other pairs."""
    frequent = frequent.sort_by("pair")
    pair, count, best = (frequent[c].to_numpy() for c in ("pair", "n", "best"))

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pairs"))
            doc = np.asarray(pc.list_parent_indices(lists))
            own, times = np.asarray(pc.list_flatten(lists)), np.asarray(pc.list_flatten(batch.column(batch.schema.get_field_index("times"))), dtype=np.int64)
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            sums, links = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, doc[hit], times[hit] * count[at[hit]])
            np.add.at(links, doc[hit], times[hit] * best[at[hit]])
            left = np.bincount(doc[~hit], minlength=batch.num_rows)
            out = batch.select([f.name for f in batch.schema if f.name not in ("pairs", "times")]).columns
            out += [pa.array(links), pa.array(sums), _lists(own[~hit], left), _lists(times[~hit], left)]
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in batch.schema if f.name not in ("pairs", "times")] + ["n_best", "count_sum", "pairs", "times"])

    return run


def link_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold an id pair (a * width + b),
    merged from the tasks' counts, and whether that is its B id's highest."""
    parts = rows.where("row is null").select(F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    total = cut(parts.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-totals")
    highest = total.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))  # a row for each id of B at most
    return cut(total.join(highest, F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-counts")


def _bar(counts: DataFrame, most: int) -> int:
    """A count that at most `most` pairs reach."""
    steps = counts.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("low")).orderBy(F.desc("low")).collect()  # at most 1,024
    bar, pairs = 1 << 62, 0
    for s in steps:
        pairs += s.pairs
        if pairs > most:
            break
        bar = s.low
    return bar


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, frequent: int = FREQUENT) -> DataFrame:
    """Align the tokens of two tokenizers over every text.

    A encodes a space and the text, B the text (and adds the space itself);
    strings of special tokens are plain text.  Returns one row per row of docs:
    doc_id, n_a and n_b (tokens), n_groups (runs of bytes at whose ends both have
    a token's end), n_links (pairs of an A and a B token that overlap), n_best
    (links whose id pair has its B id's highest count in the corpus, ties
    included), count_sum (the counts of all its links) and groups_sha256.

    A null or empty text, and one that the tokens of A or B don't spell (a model
    may normalise), has zeros and an empty groups_sha256.  doc_id may be null or
    repeat, each row stands for itself; further columns are ignored; an empty
    table gives no rows.  A text is encoded whole, in the task that reads it.

    byte_bpe and piece_bpe are paths on the driver; their contents are broadcast
    (some 2 MB, of the vocabulary's size).  So are the counts of the `frequent`
    most frequent pairs at most; only the documents' other pairs are shuffled.
    """
    spark = docs.sparkSession
    with open(byte_bpe, encoding="utf-8") as file, open(piece_bpe, "rb") as other:
        models = spark.sparkContext.broadcast((file.read(), other.read()))
    width = len(piece_level(models.value[1])[1])
    rows = cut(texts(docs).mapInArrow(_align(models), ROW), "alignment-rows", "zstd")
    counts = link_counts(rows, width)
    bar = _bar(counts, frequent)
    known = counts.where(F.col("n") >= bar).select("pair", "n", "best").toArrow()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ROW.split(", pairs")[0] + ", n_best long, count_sum long, pairs array<int>, times array<int>"
    summed = cut(rows.where("row is not null").drop("counts").mapInArrow(_known(known), schema), "alignment-known", "zstd")
    rare = summed.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    rare = rare.join(counts.where(F.col("n") < bar), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = summed.select(*names, "n_best", "count_sum").join(rare, "row", "left")
    add = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return out.select(*names[1:6], add("n_best", "more_best"), add("count_sum", "more_sum"), "groups_sha256")


def op13_token_alignment(spark, sf_dir):
    return align(documents(spark, sf_dir))
