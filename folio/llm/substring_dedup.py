"""Exact substring deduplication (operator 10).

Suffix automata of reference shards: documents are streamed through the
automaton of each shard they share text with, and every maximal span of words
whose windows occur in an earlier document is removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.automaton import SuffixAutomaton
from folio.llm.common import cut, documents, group_rows, texts

WINDOW = 13
SEED = 5
#: Documents with one seed that are matched together.
SHARD_DOCUMENTS = 2048
#: Words of the shard's first document whose seeds make up one shard.
REGION = 512
#: Words an automaton holds (some 350 bytes each); what it held before is kept as
#: the hashes of its windows (16 bytes each).
AUTOMATON_WORDS = 200_000
SPAN = "shard long, split int, salt int, doc_id long, key long, start int, words binary, seeds binary"
FRESH_WINDOWS = "one long, two long, doc_id long, key long, starts array<int>"
FRESH = "doc_id long, key long, start int, stop int, words binary"


def selected_seeds(words: wb.Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text row, word index in the text) of each window's smallest seed.

    Equal windows have equal seeds, so two documents that share a window share
    the seed selected in it; of `window` words about one in five is selected.
    """
    hashes = words.hashes()
    runs, at = wb.grams(hashes, words.first, seed)
    width = window - seed + 1
    count = np.maximum(np.diff(words.first) - window + 1, 0)
    if not count.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = at[row] + offset
    best, place = runs[begin], begin.copy()
    for j in range(1, width):
        other = runs[begin + j]
        lower = other < best
        best = np.where(lower, other, best)
        place = np.where(lower, begin + j, place)
    new = np.ones(len(place), dtype=bool)  # neighbouring windows mostly agree
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    return best[new], row[new], (place - at[row])[new]


def _seeds(window: int, seed: int):
    def run(batches):
        for batch in wb.text_chunks(batches, "text"):
            words = wb.split_words(*wb.utf8(batch.column(1)), False)
            h, row, place = selected_seeds(words, window, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.astype(np.int64)), batch.column(0).take(pa.array(row)), batch.column(2).take(pa.array(row)), pa.array(place.astype(np.int32))],
                names=["seed", "doc_id", "key", "place"],
            )

    return run


def _spans(window: int, seed: int, per_shard: int):
    """Documents with the shared seeds found in them -> spans by shard."""

    def run(batches):
        for batch in wb.text_chunks(batches, "text"):
            words = wb.split_words(*wb.utf8(batch.column(1)), False)
            hashes = words.hashes()
            h, row, place = selected_seeds(words, window, seed)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            known = batch.column(3)
            out = {"shard": [], "split": [], "salt": [], "doc_id": [], "key": [], "start": [], "words": [], "seeds": []}
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                shared = known[i].values
                if shared is None or not len(shared):
                    continue
                keys = shared.field("seed").to_numpy().astype(np.uint64)
                order = np.argsort(keys)
                keys = keys[order]
                own = h[bounds[i] : bounds[i + 1]]
                found = np.searchsorted(keys, own)
                found[found == len(keys)] = 0
                hit = keys[found] == own
                at = place[bounds[i] : bounds[i + 1]][hit]
                region = shared.field("place").to_numpy()[order][found[hit]] // REGION
                low = shared.field("low").to_numpy()[order][found[hit]]
                low = (wb.mix(low.astype(np.uint64)) + region.astype(np.uint64)).astype(np.int64)
                # hot seeds are matched in salted parts first; all of a seed's documents agree on how many
                parts = -(-shared.field("n").to_numpy()[order][found[hit]] // per_shard)
                split = np.where(parts > 1, np.ceil(np.log2(np.maximum(parts, 1))), 0).astype(np.int64)
                n = words.first[i + 1] - words.first[i]
                order = np.lexsort((at, split, low))
                at, low, split = at[order], low[order], split[order]
                begin, end = np.maximum(at - (window - seed), 0), np.minimum(at + window, n)
                new = np.ones(len(at), dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (split[1:] != split[:-1]) | (begin[1:] > end[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(at)) - 1
                salt = int(wb.mix(np.array([doc], dtype=np.int64).astype(np.uint64))[0] >> wb.U(33))
                base = words.first[i]
                for a, b in zip(first.tolist(), last.tolist()):
                    out["shard"].append(int(low[a]))
                    out["split"].append(int(split[a]))
                    out["salt"].append(salt % (1 << int(split[a])))
                    out["doc_id"].append(doc)
                    out["key"].append(text)
                    out["start"].append(int(begin[a]))
                    out["words"].append(hashes[base + begin[a] : base + end[b]].tobytes())
                    out["seeds"].append((at[a : b + 1] - begin[a]).tobytes() if split[a] else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[k], t)
                    for k, t in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))
                ],
                names=list(out),
            )

    return run


def _selecting(words: np.ndarray, seeds: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Which windows of a run of words select one of the seeds at these places."""
    runs, _ = wb.grams(words, np.array([0, len(words)]), seed)
    first = np.lib.stride_tricks.sliding_window_view(runs, window - seed + 1).argmin(axis=1)
    marked = np.zeros(len(runs), dtype=bool)
    marked[seeds] = True
    return marked[first + np.arange(len(first))]


def _window_hashes(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window of a run of words."""
    bounds = np.array([0, len(words)])
    return wb.grams(words, bounds, window)[0], wb.grams(wb.mix(words ^ wb.U(0x5851F42D4C957F2D)), bounds, window)[0]


class _Reference:
    """What a shard's earlier documents brought: an automaton of bounded size, and
    the window hashes of what filled the automata before it."""

    def __init__(self, window: int):
        self.window, self.held, self.one, self.two = window, [], np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.automaton, self.size = SuffixAutomaton(), 0

    def seen(self, words: np.ndarray) -> np.ndarray:
        """Which windows of a document occur in it."""
        out = np.zeros(max(len(words) - self.window + 1, 0), dtype=bool)
        if self.size:
            out[self.automaton.windows(words.tolist(), self.window)] = True
        if len(self.one) and len(out):
            one, two = _window_hashes(words, self.window)
            at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
            out |= (self.one[at] == one) & (self.two[at] == two)
        return out

    def add(self, words: np.ndarray) -> None:
        if len(words) > AUTOMATON_WORDS + self.window:  # in pieces that share all windows
            for start in range(0, len(words) - self.window + 1, AUTOMATON_WORDS):
                self.add(words[start : start + AUTOMATON_WORDS + self.window - 1])
            return
        if self.size >= AUTOMATON_WORDS:
            hashes = [(self.one, self.two), *[_window_hashes(x, self.window) for x in self.held]]
            one, two = (np.concatenate(x) for x in zip(*hashes))
            order = np.argsort(one)
            self.one, self.two = one[order], two[order]
            self.held, self.automaton, self.size = [], SuffixAutomaton(), 0
        self.automaton.add(words.tolist())
        self.held.append(words)
        self.size += len(words)


def _match(window: int, seed: int):
    """Stream each shard's spans, in document order, through its automaton.

    Yields the removed word ranges.  What was new in the shard is what a later
    document can repeat, so only that enters the automaton.  The new words of
    salted parts are yielded as well (with words), to meet the other parts'.
    Only windows that select one of the shard's seeds count there: the others
    round a hot passage meet in the shards of the seeds they do select.
    """

    def run(batches):
        for (_, split, _), group in group_rows(batches, ["shard", "split", "salt"]):
            earlier = _Reference(window)
            out = {"doc_id": [], "key": [], "start": [], "stop": [], "words": []}

            def put(*row):
                for k, v in zip(out, row):
                    out[k].append(v)

            ids, keys, starts, texts_, seeds = (group.column(k).to_pylist() for k in ("doc_id", "key", "start", "words", "seeds"))
            i = 0
            while i < len(ids):
                fresh = []
                doc = ids[i]
                while i < len(ids) and ids[i] == doc:
                    words = np.frombuffer(texts_[i], dtype=np.uint64)
                    seen = earlier.seen(words)
                    for a, b in _runs(seen):
                        put(doc, keys[i], starts[i] + a, starts[i] + b + window - 1, None)
                    fresh += [words[a : b + window - 1] for a, b in _runs(~seen)]
                    if split:
                        own = _selecting(words, np.frombuffer(seeds[i], np.int64), window, seed)
                        for a, b in _runs(~seen & own):
                            put(doc, keys[i], starts[i] + a, None, words[a : b + window - 1].tobytes())
                    i += 1
                if i < len(ids):  # nothing reads what the last document adds
                    for piece in fresh:
                        earlier.add(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[k], t) for k, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=list(out),
            )

    return run


def _fresh_windows(window: int):
    """The windows of the parts' new words: a 128-bit hash and its places, once
    for each run of words however often it repeats itself."""

    def run(batches):
        for batch in batches:
            for doc, key, start, _, words in zip(*[c.to_pylist() for c in batch.columns]):
                h = np.frombuffer(words, dtype=np.uint64)
                one, two = _window_hashes(h, window)
                order = np.lexsort((two, one))
                one, two = one[order], two[order]
                first = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
                one, two, n = one[first], two[first], len(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.astype(np.int64)),
                        pa.array(two.astype(np.int64)),
                        pa.array(np.full(n, doc, np.int64)),
                        pa.array(np.full(n, key, np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array((start + order).astype(np.int32))),
                    ],
                    names=["one", "two", "doc_id", "key", "starts"],
                )

    return run


def _runs(flags: np.ndarray):
    """(first, one past the last) of each run of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())


def removed_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED, per_shard: int = SHARD_DOCUMENTS) -> DataFrame:
    """Word ranges [start, stop) of the rows (doc_id, key) that an earlier document holds.

    A range is listed once for each shard that finds it; ranges may overlap.
    docs has doc_id, text and key, a hash of the text.
    """
    seeds = docs.mapInArrow(_seeds(window, seed), "seed long, doc_id long, key long, place int")
    shared = (
        seeds.groupBy("seed")
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
        .where("first.doc_id < high")
        .select("seed", F.col("first.doc_id").alias("low"), F.col("first.place").alias("place"), "n")
    )
    shared = cut(shared, "substring-seeds")  # a table, so that the join can be split where a seed is hot
    by_doc = (
        seeds.select("seed", "doc_id", "key")
        .join(shared, "seed")
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("seed", "low", "place", "n")).alias("shared"))
    )
    spans = docs.join(by_doc, ["doc_id", "key"]).select("doc_id", "text", "key", "shared").mapInArrow(_spans(window, seed, per_shard), SPAN)
    parts = ["shard", "split", "salt"]
    spans = spans.repartition(*parts).sortWithinPartitions(*parts, "doc_id", "key", "start")
    matched = cut(spans.mapInArrow(_match(window, seed), FRESH), "substring-matched")
    # windows that were new in several salted parts: the first document keeps them
    fresh = matched.where("words is not null").mapInArrow(_fresh_windows(window), FRESH_WINDOWS)
    # dealt out once: with all columns and conditions on either side, Spark reuses the shuffle
    fresh = fresh.where("one is not null and two is not null and doc_id is not null").repartition("one", "two")
    first = fresh.groupBy("one", "two").agg(F.min(F.struct("doc_id", "key", "starts"))["doc_id"].alias("first"))
    again = fresh.join(first, ["one", "two"]).where("first < doc_id").select("doc_id", "key", F.explode_outer("starts").alias("start"))
    found = matched.where("words is null").select("doc_id", "key", "start", "stop")
    return found.union(again.select("doc_id", "key", "start", (F.col("start") + window).cast("int").alias("stop")))


def _strip(batches):
    for batch in wb.text_chunks(batches, "text"):
        words = wb.split_words(*wb.utf8(batch.column(1)), False)
        total, gone, kept, digest = [], [], [], []
        for i in range(batch.num_rows):
            a, b = int(words.first[i]), int(words.first[i + 1])
            keep = np.ones(b - a, dtype=bool)
            ranges = batch.column(2)[i].as_py() or ()
            for x in ranges:
                keep[x["start"] : x["stop"]] = False
            begin, end = words.begin[a:b][keep].tolist(), words.end[a:b][keep].tolist()
            text = b" ".join([words.data[x:y].tobytes() for x, y in zip(begin, end)]) if len(ranges) else _joined(words, a, b)
            total.append(b - a)
            gone.append(b - a - len(begin))
            kept.append(text.decode())
            digest.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(digest)],
            names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def _joined(words: wb.Words, a: int, b: int) -> bytes:
    return b" ".join(words.data[words.begin[a] : words.end[b - 1]].tobytes().split()) if b > a else b""


def remove_repeated_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove every word in a window of `window` words that also starts in a
    document with a smaller doc_id.

    Words are runs of bytes other than space and \\t..\\r, unchanged; windows are
    judged on the input, not on what is left.  Returns one row per input row:
    doc_id, n_words, n_removed, kept_text (kept words joined by one space) and
    kept_sha256 of that.  A null or empty text has no words; texts shorter than
    a window lose nothing.  Rows that repeat a doc_id are parts of one document
    and do not remove each other's words; each loses what its own text repeats
    from smaller ids.  Rows without a doc_id lose nothing, and remove nothing.
    Further columns are ignored.

    Shards.  Every window selects its smallest five-word seed.  Seeds found in
    two or more documents are the only ones that matter.  The smallest document
    holding a seed, and the region of REGION words where it stands there, name
    the seed's shard, so all documents that share a window meet in one shard
    with the words around it, and a shard does not grow with that document's
    length.  There an automaton of what earlier documents brought answers each
    document's matching statistics; an automaton that is full makes way for an
    empty one, and its windows stay as hashes.  Seeds in more than SHARD_DOCUMENTS documents
    are matched in salted parts; the windows that are new in each part are
    settled by the least doc_id of every window, an aggregation.
    """
    docs = texts(docs).withColumn("key", F.xxhash64("text"))
    known = docs.where("doc_id is not null")
    ranges = (
        removed_spans(known, window).groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    )
    rest = docs.where("doc_id is null").withColumn("ranges", F.lit(None).cast("array<struct<start int, stop int>>"))
    return (
        known.join(ranges, ["doc_id", "key"], "left")  # shares the shuffle of texts with removed_spans
        .select("doc_id", "text", "ranges")
        .union(rest.select("doc_id", "text", "ranges"))
        .mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    )


def op10_substring_dedup(spark, sf_dir):
    return remove_repeated_substrings(documents(spark, sf_dir)).drop("kept_text")
