"""Benchmark decontamination by greedy string tiling (operator 5).

Documents and benchmark items that share a five-word seed are tiled: the longest
common run of words not yet marked is marked in both, again and again, until no
run of at least a seed is left.  The share of an item's words under tiles decides,
so passages in another order, or broken up, count in full.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, texts

TILE = 5
COVERAGE = 0.5
#: Characters of benchmark text that one pass over the documents carries along.
BLOCK_CHARS = 8_000_000
FOUND = (
    "doc_id long, item_id long, item_words long, tiled_words long, tiles array<struct<doc_word:int,item_word:int,words:int>>, "
    "coverage double"
)


#: Base of the running hash of word windows, and its inverse.
_RUN = wb.U(0xD1342543DE82EF95)
_RUN_INVERSE = wb.U(pow(int(_RUN), -1, 1 << 64))


class _Windows:
    """Karp-Rabin hashes of runs of words, of any length, and what is not yet marked."""

    def __init__(self, words: np.ndarray, follows: np.ndarray):
        self.words, self.follows = words, follows
        self.free = np.ones(len(words), dtype=bool)
        self.back = wb.powers(_RUN_INVERSE, len(words))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * wb.powers(_RUN, len(words)), dtype=np.uint64)))

    def room(self) -> np.ndarray:
        """How many unmarked words stand in a row from each word on."""
        n = len(self.words)
        ends = np.flatnonzero(np.append(~self.free | ~self.follows, True))  # a run stops before each
        stop = ends[np.searchsorted(ends, np.arange(n), "right")]
        return np.where(self.free, stop - np.arange(n), 0)

    def hashes(self, length: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the unmarked windows of a length: a difference of
        two running sums, turned back by the place."""
        at = np.flatnonzero(room >= length)
        return at, (self.sums[at + length] - self.sums[at]) * self.back[at]

    def open(self, at: int, length: int) -> bool:
        return bool(self.free[at] and self.free[at + length - 1])  # marks of a round are as long, so ends tell


def tile(doc: np.ndarray, place: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (doc word, item word, length) of a document's and an item's
    word hashes; place has the document words' numbers, with gaps where words
    that are in no shared seed were left out.

    Running Karp-Rabin, from long to short: the greatest length at which an
    unmarked window of the document has the hash of one of the item is found by
    halving (a match holds shorter ones), and all matches of that length are
    marked, earliest in the document (then in the item) first, until none of
    `size` words is left.  Windows whose hashes agree are compared word by word.
    Time and memory follow the words of both for each length that occurs, and
    there are at most sqrt(2 * item words) of these.
    """
    left = _Windows(doc, np.append(False, np.diff(place) == 1)[: len(doc)])
    right = _Windows(item, np.append(False, np.ones(max(len(item) - 1, 0), dtype=bool))[: len(item)])
    tiles, longest = [], len(item)
    while True:
        rooms = left.room(), right.room()

        def shared(length: int):
            (at, mine), (to, other) = left.hashes(length, rooms[0]), right.hashes(length, rooms[1])
            return at[np.isin(mine, other)], to

        low, high = size - 1, min(longest, int(rooms[0].max(initial=0)), int(rooms[1].max(initial=0)))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(shared(middle)[0]) else (low, middle - 1)
        if low < size:
            return tiles
        at, to = shared(low)
        queues: dict[int, deque] = {}
        for i, h in zip(to.tolist(), right.hashes(low, rooms[1])[1].tolist()):
            queues.setdefault(h, deque()).append(i)
        marked = len(tiles)
        for d, h in zip(at.tolist(), ((left.sums[at + low] - left.sums[at]) * left.back[at]).tolist()):
            waiting = queues[h]
            while waiting and not right.open(waiting[0], low):
                waiting.popleft()
            if waiting and left.open(d, low) and (doc[d : d + low] == item[waiting[0] : waiting[0] + low]).all():
                i = waiting.popleft()
                tiles.append((int(place[d]), i, low))
                left.free[d : d + low] = False
                right.free[i : i + low] = False
        longest = low if len(tiles) > marked else low - 1


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... (count[0] of them), low[1], ..."""
    return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _matching(ids: list[int], items: list[str], size: int, coverage: float):
    """What finds the matches of a batch of documents with a block of benchmark items."""
    words = wb.split_words(*wb.utf8(pa.array(items, pa.string())), True, wb.NOT_ALNUM)
    item_hashes = words.hashes()
    seeds, at = wb.grams(item_hashes, words.first, size)
    row = np.repeat(np.arange(len(items)), np.diff(at))
    place = np.arange(len(seeds)) - at[row]
    order = np.argsort(seeds, kind="stable")
    seeds, row, place = seeds[order], row[order], place[order]
    length = np.diff(words.first)
    quick = np.zeros(1 << 20, dtype=bool)
    quick[seeds >> wb.U(44)] = True

    def candidates(found: np.ndarray):
        """Items of whose words enough lie under the seeds found in a document.

        found has distinct hashes, so this is bounded by the block's seeds."""
        low, high = np.searchsorted(seeds, found, "left"), np.searchsorted(seeds, found, "right")
        index = _ranges(low, high - low)
        item, start = row[index], place[index]
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        if not len(item):
            return item
        new = np.append(True, np.diff(item) != 0)
        ahead = np.append(start[1:], 0) - start
        ahead[np.append(new[1:], True)] = size  # of an item's last seed, all words
        first = np.flatnonzero(new)
        covered = np.add.reduceat(np.minimum(ahead, size), first)
        return item[first][covered >= coverage * length[item[first]]]

    def matches(batch, column: int):
        """(row, item, words, tiled words, tiles) of the texts of a batch."""
        text = wb.split_words(*wb.utf8(batch.column(column)), True, wb.NOT_ALNUM)
        hashes = text.hashes()
        h, begin = wb.grams(hashes, text.first, size)
        likely = np.flatnonzero(quick[h >> wb.U(44)])
        known = seeds[np.minimum(np.searchsorted(seeds, h[likely]), max(len(seeds) - 1, 0))] == h[likely] if len(seeds) else np.zeros(len(likely), bool)
        likely = likely[known]
        doc = np.searchsorted(begin, likely, "right") - 1
        edge = np.flatnonzero(np.append(True, np.diff(doc) != 0)) if len(doc) else []
        for a, b in zip(edge, [*edge[1:], len(doc)]):
            d = int(doc[a])
            spot, hit = likely[a:b] - begin[d], h[likely[a:b]]
            for k in candidates(np.unique(hit)).tolist():
                own = item_hashes[words.first[k] : words.first[k + 1]]
                mine = spot[np.isin(hit, wb.grams(own, np.array([0, len(own)]), size)[0])]
                near = np.unique(mine[:, None] + np.arange(size)[None, :])  # words in seeds of this item
                tiles = tile(hashes[text.first[d] + near], near, own, size)
                tiled = sum(t[2] for t in tiles)
                if tiled >= coverage * len(own):
                    yield d, ids[k], len(own), tiled, sorted(tiles)

    return matches


def _pairs(matches):
    """The task that gives a row for each match."""

    def run(batches):
        for batch in wb.text_chunks(batches, "text"):
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "doc_id": batch.column(0)[d].as_py(),
                        "item_id": i,
                        "item_words": n,
                        "tiled_words": t,
                        "tiles": [{"doc_word": x, "item_word": y, "words": z} for x, y, z in tiles],
                        "coverage": t / n,
                    }
                    for d, i, n, t, tiles in matches(batch, 1)
                ],
                schema=_SCHEMA,
            )

    return run


def _search(ids: list[int], items: list[str], size: int, coverage: float):
    """A task over document batches, for one block of benchmark items."""
    return _pairs(_matching(ids, items, size, coverage))


def _clean(matches, column: int):
    """The task that lets through the rows, all columns of them, without a match."""

    def run(batches):
        for batch in batches:
            for part in wb.text_chunks([batch], batch.schema.names[column], at=column):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[d for d, *_ in matches(part, column)]] = False
                yield part.filter(pa.array(keep))

    return run


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("item_words", pa.int64()),
        ("tiled_words", pa.int64()),
        ("tiles", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))),
        ("coverage", pa.float64()),
    ]
)


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = TILE, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pairs of documents and benchmark items of whose words at least `coverage`
    lie under tiles of `size` or more words in the document.

    Words are runs of letters and digits (all non-ASCII characters count as
    letters), A-Z lower-cased.  Returns doc_id, item_id, item_words,
    tiled_words, tiles (word ranges in both) and coverage, a row for each pair.
    Null or empty texts and items, and items of fewer than `size` words, match
    nothing.  Repeated document rows give repeated rows; repeated items (same id
    and text) count once; further columns are ignored.

    Items travel to the documents in blocks of about block_chars, chosen by hash;
    a larger benchmark takes more passes over the documents, not more memory.
    The documents are never shuffled.  What a task holds for a document and an
    item follows their words, however often these repeat.
    """
    docs = texts(docs)
    found = docs.sparkSession.createDataFrame([], FOUND)
    for n, matches in enumerate(_blocks(benchmark, size, coverage, block_chars)):
        pairs = docs.mapInArrow(_pairs(matches), FOUND)
        found = found.union(pairs) if n else pairs
    return found


def _blocks(benchmark: DataFrame, size: int, coverage: float, block_chars: int):
    """What finds matches, for each block of items."""
    items = texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id").where("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow().sort_by("item_id")
        yield _matching(part.column("item_id").to_pylist(), part.column("text").to_pylist(), size, coverage)


def without_leaks(docs: DataFrame, benchmark: DataFrame, size: int = TILE, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that hold no benchmark item (see leaks), as they are.

    Every row is judged by its own text, in the task that reads it, and dropped
    or passed on there: neither a doc_id that is null or stands on several rows
    nor any other column matters, repeated rows stay or go alike, and nothing is
    shuffled.  Of a benchmark of several blocks each takes away its share; what
    is left is written in between, so that no task carries two blocks.
    """
    column = docs.columns.index("text")
    left = docs
    for n, matches in enumerate(_blocks(benchmark, size, coverage, block_chars)):
        left = (cut(left, "decontamination") if n else left).mapInArrow(_clean(matches, column), docs.schema)
    return left


def op5_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks(documents(spark, sf_dir), benchmark).drop("tiles")
