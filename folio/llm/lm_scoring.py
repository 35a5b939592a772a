"""Language-model scores by logistic context mixing (operator 3).

Bit predictors for contexts of one to five bytes count what followed in the
training texts, exactly.  A mixer combines their log-odds by weights that a gate
selects (how many contexts are known, which bit), learnt online; an adaptive map
refines its output.  Contexts reach back five bytes, so what a byte costs depends
on the six-byte string it ends, and every distinct string of the corpus is worked
out once, where the strings with its last three context bytes are.  Costs and the
counts of all training words are tables that grow with the corpus; groups of
texts look theirs up in it.  A second gate mixes, word by word, the bytes'
probability with that of the dictionary and with what the text itself has
repeated so far; it is fitted on all training texts, by how often each
combination of these stands in them.  A word-count model is scored beside it as base.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, group_rows, texts

ORDERS = (1, 2, 3, 4, 5)
REACH = ORDERS[-1]
#: Orders whose counts travel to the tasks: at most 2**24 strings of three bytes.
SHORT = 2
END = 0xFF  # no byte of UTF-8: ends a text
PRIOR = 0.1
GATES = (len(ORDERS) + 1) * 8
BUCKETS = 33
RATE, STEADY = 0.1, 1000.0
#: Bytes of text for each part of the count tables.
PART_BYTES = 5 << 20
#: Bytes of text that look up their grams and words together.
GROUP_BYTES = 6 << 20
#: Set in the keys of words, to tell them from grams (48 bits) in the lookup table.
WORD = wb.U(1 << 63)
#: Most frequent words that travel to the tasks; the rest is looked up by a join.
FREQUENT_WORDS = 1 << 18
#: Distinct strings that a task counts before it hands them on.
MEMO = 2_000_000
#: Kinds of counts: byte strings, pieces, words of the base, totals.
GRAM, PIECE, BASE, TOTAL = range(4)
CHUNK = 1 << 20
WORD_GATES = 40
#: Steps of the word experts' log2 odds against the bytes, and steps to a bit.
STEPS, FINENESS = 64, 2


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram of every byte and end, texts' bounds): five bytes back and the byte."""
    size = np.diff(offsets)
    first = np.concatenate(([0], np.cumsum(size + 1)))
    starts = offsets[:-1] + np.arange(len(size)) * (REACH + 1)  # REACH zeros, the text, its end
    real = np.ones(len(data) + len(size) * (REACH + 1), dtype=bool)
    real[(starts[:, None] + np.arange(REACH)[None, :]).ravel()] = False
    ends = starts + REACH + size
    tape = np.zeros(len(real), dtype=np.uint64)
    tape[ends] = END
    real[ends] = False
    tape[real] = data
    real[ends] = True
    code = tape.copy()
    for back in range(1, REACH + 1):
        code[back:] |= tape[:-back] << wb.U(8 * back)
    return code[real], first


class Counts:
    """How often each string of order + 1 bytes stands in the training texts.

    A string's key is its bytes as a number, so the strings that go on from one
    context by the same first bits of a byte are neighbours, and their count is
    a difference of two prefix sums.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, short: "Counts | None" = None):
        """Of grams for all orders; with `short` orders up to SHORT are taken from it."""
        self.tables = {} if short is None else dict(short.tables)
        for order in ORDERS:
            if order not in self.tables:
                keys, at = np.unique(grams & self.mask(order), return_inverse=True)
                sums = np.cumsum(np.bincount(at, weights=n, minlength=len(keys)))
                self.tables[order] = keys, np.concatenate(([0.0], sums))

    @staticmethod
    def mask(order: int) -> np.uint64:
        return wb.U((1 << (8 * (order + 1))) - 1)

    def after(self, order: int, keys: np.ndarray) -> np.ndarray:
        """(keys, 9): what follows the context with 0 .. 8 first bits of the byte."""
        known, sums = self.tables[order]
        out = np.empty((len(keys), 9))
        for j in range(9):
            low = (keys >> wb.U(8 - j)) << wb.U(8 - j)
            out[:, j] = sums[np.searchsorted(known, low + wb.U(1 << (8 - j)))] - sums[np.searchsorted(known, low)]
        return out

    def of(self, grams: np.ndarray):
        """A function from a slice to (ones, zeros, bits) of these grams, of
        shapes (grams, 8, orders) and (grams, 8)."""
        taken, other, at = [], [], []
        for order in ORDERS:
            keys, place = np.unique(grams & self.mask(order), return_inverse=True)
            n = self.after(order, keys)
            taken.append(n[:, 1:].astype(np.float32))
            other.append((n[:, :-1] - n[:, 1:]).astype(np.float32))
            at.append(place.astype(np.int32))

        def part(a: int, b: int):
            byte = (grams[a:b] & wb.U(0xFF)).astype(np.int64)
            bits = (byte[:, None] >> np.arange(7, -1, -1)) & 1
            yes = np.stack([t[p[a:b]] for t, p in zip(taken, at)], axis=2)
            no = np.stack([t[p[a:b]] for t, p in zip(other, at)], axis=2)
            up = bits[:, :, None] == 1
            return np.where(up, yes, no), np.where(up, no, yes), bits

        return part


class Model(NamedTuple):
    short: Counts  # counts of orders up to SHORT
    weights: np.ndarray  # (gates, orders + 1)
    refine: np.ndarray  # (gates, buckets): log-odds


def log_odds(ones, zeros):
    return np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32)


def _gate(inputs: np.ndarray) -> np.ndarray:
    known = np.count_nonzero(inputs[:, :, : len(ORDERS)], axis=2)
    return known * 8 + np.arange(8)


def _inputs(odds: np.ndarray) -> np.ndarray:
    """Log-odds of the orders, and a constant."""
    return np.concatenate([odds, np.full((*odds.shape[:2], 1), 0.3, np.float32)], axis=2)


def _buckets(x: np.ndarray):
    at = (np.clip(x, -7.999, 7.999) + 8) * (BUCKETS - 1) / 16
    low = at.astype(np.int32)
    return low, (at - low).astype(np.float32)


def bit_costs(weights: np.ndarray, refine: np.ndarray, counts: Counts, grams: np.ndarray) -> np.ndarray:
    """Bits that the last byte of each gram costs after the bytes before it."""
    out = np.empty(len(grams), dtype=np.float32)
    part = counts.of(grams)
    for a in range(0, len(grams), 16_384):
        ones, zeros, bits = part(a, a + 16_384)
        inputs = _inputs(log_odds(ones, zeros))
        gate = _gate(inputs)
        x = np.einsum("gbi,gbi->gb", inputs, weights[gate])
        low, share = _buckets(x)
        x = 0.5 * x + 0.5 * (refine[gate, low] * (1 - share) + refine[gate, low + 1] * share)
        sign = 1 - 2 * bits.astype(np.float32)
        out[a : a + 16_384] = np.logaddexp(0, sign * x).sum(axis=1) / np.log(2)
    return out


def _new(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys differ from the one before."""
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return new


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key among the distinct ones; these in order).

    Sorting 64-bit numbers takes a fraction of the time that hashing them does.
    """
    order = np.argsort(keys)
    ordered = keys[order]
    new = _new(ordered)
    codes = np.empty(len(keys), dtype=np.int32)
    codes[order] = np.cumsum(new, dtype=np.int32) - 1
    return codes, ordered[new]


def _tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in order, and how often each stands."""
    keys = np.sort(keys)
    first = np.flatnonzero(_new(keys))
    return keys[first], np.diff(np.append(first, len(keys)))


_LAST = np.zeros(256, dtype=bool)  # bytes that end a piece: white space, and the end
_LAST[[0x20, 9, 10, 11, 12, 13, END]] = True


class Pieces(NamedTuple):
    """A text's words, each with the one byte of white space (or end) after it."""

    h: np.ndarray  # hash of the bytes
    stood: np.ndarray  # what stood before: 0 a word, 1 . ! or ?, 2 a line's end, 3 nothing
    start: np.ndarray  # first symbol
    text: np.ndarray  # number of its text

    @property
    def key(self) -> np.ndarray:
        return wb.mix(self.h + self.stood.astype(np.uint64) * wb.U(7919))


def pieces_of(code: np.ndarray) -> Pieces:
    """The pieces of a run of symbols; each symbol is in one piece."""
    byte = (code & wb.U(0xFF)).astype(np.uint8)
    last = _LAST[byte]
    start, end = np.flatnonzero(np.concatenate(([True], last[:-1]))), np.flatnonzero(last) + 1
    sums = np.zeros(len(byte) + 1, dtype=np.uint64)
    np.cumsum(wb._LETTER[byte] * wb.powers(wb._BASE, len(byte)), out=sums[1:])
    back = wb.powers(wb._BASE_INVERSE, len(byte) + 1)
    h = wb.mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * wb.U(0x9FB21C651E98DF25))
    before = ((code[start] >> wb.U(8)) & wb.U(0xFF)).astype(np.uint8)
    second = ((code[start] >> wb.U(16)) & wb.U(0xFF)).astype(np.uint8)
    stood = np.where(before == 0, 3, np.where(before == 10, 2, np.where(np.isin(second, (46, 33, 63)), 1, 0)))
    return Pieces(h, stood, start, np.concatenate(([0], np.cumsum(byte == END)[:-1]))[start])


def _earlier(text: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """How often each piece's keys stood earlier in its text; texts are in order."""
    order = None
    for key in keys:  # small numbers of 16 bits are sorted by digits
        key = key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key
        order = np.argsort(key, kind="stable") if order is None else order[np.argsort(key[order], kind="stable")]
    new = np.logical_or.reduce([_new(x[order]) for x in (text, *keys)])
    first = np.flatnonzero(new)
    out = np.empty(len(text), dtype=np.int64)
    out[order] = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    return out


def dictionary_chance(p: Pieces, n_words: np.ndarray, totals: np.ndarray, without: int = 0) -> np.ndarray:
    """Share of each piece among those after the same kind of thing."""
    return np.maximum(n_words - without, 0) / np.maximum(totals[p.stood] - without, 1)


def own_chances(p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each piece's chance by the text so far, by what followed the piece before
    in the text so far, and its gate."""
    fresh = np.concatenate(([True], p.text[1:] != p.text[:-1]))
    first = np.flatnonzero(fresh)
    n = np.arange(len(p.h)) - np.repeat(first, np.diff(np.append(first, len(p.h))))
    piece = _distinct(p.h)[0] + 1
    before = np.where(fresh, 0, np.concatenate(([0], piece[:-1])))
    followed = _earlier(p.text, before)
    own = _earlier(p.text, piece) / np.maximum(n, 1)
    pair = _earlier(p.text, piece, before) / np.maximum(followed, 1)
    gate = np.minimum(np.log2(n + 1).astype(np.int64), 9) * 4 + np.minimum(followed, 3)
    return own, pair, gate


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of counts(n) above the least n that at most `limit` rows reach.

    Found from how many rows have each n, so no task sorts or gathers the rows.
    """
    kept, least = 0, None
    for r in counts.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).toLocalIterator():
        if kept + r["rows"] > limit:
            break
        kept, least = kept + r["rows"], r["n"]
    return counts.where(F.lit(False) if least is None else F.col("n") >= least)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the tables that a key is in: strings by the three bytes
    before their last, so that a part has all that follows them; words by hash."""
    return (wb.mix(np.where(keys >= WORD, keys, (keys >> wb.U(8)) & wb.U(0xFFFFFF))) % wb.U(parts)).astype(np.int64)


def _packs(part: np.ndarray, parts: int):
    """(order of the keys by part, [(part, from, to)]); in a part they stay in order."""
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    return order, [(q, a, b) for q, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if a < b]


def _bytes_of(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, so that small ones compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers_of(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _keys_packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their distances."""
    return _bytes_of(np.diff(keys, prepend=wb.U(0)))


def _keys_of(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers_of(data), dtype=np.uint64)


COUNTED = "kind int, part int, keys binary, n binary"


def _counted(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    kinds, parts, keys, n = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kinds, pa.int32()),
            pa.array(parts, pa.int32()),
            pa.array([_keys_packed(x) for x in keys], pa.binary()),
            pa.array([_bytes_of(x.astype(np.int64)) for x in n], pa.binary()),
        ],
        names=["kind", "part", "keys", "n"],
    )


def _sum_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    keys, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(_new(keys))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _tally(parts: int):
    """All counts of a task's texts, packed by kind and part.

    Strings of texts that aren't learned from are counted as 0, to get a cost.
    """

    def run(batches):
        held: dict[int, list] = {GRAM: [], PIECE: [], BASE: [], TOTAL: []}

        def packed():
            rows = []
            for kind, some in held.items():
                if not some:
                    continue
                keys, n = _sum_up(some)
                part = np.zeros(len(keys), np.int64) if kind == TOTAL else part_of(keys | WORD if kind == BASE else keys, parts)
                order, places = _packs(part, parts)
                keys, n = keys[order], n[order]
                rows += [(kind, q, keys[a:b], n[a:b]) for q, a, b in places]
                some.clear()
            return _counted(rows)

        for batch in wb.text_chunks(batches, "text", CHUNK):
            data, offsets = wb.utf8(batch.column(batch.schema.get_field_index("text")))
            learning = batch.column(batch.schema.get_field_index("learning")).to_numpy(zero_copy_only=False)
            code, first = symbols(data, offsets)
            marked = np.sort((code << wb.U(1)) | np.repeat(learning, np.diff(first)))  # with a bit for learning
            at = np.flatnonzero(_new(marked >> wb.U(1)))
            learnt = np.concatenate(([0], np.cumsum(marked & wb.U(1), dtype=np.int64)))
            held[GRAM].append((marked[at] >> wb.U(1), learnt[np.append(at[1:], len(marked))] - learnt[at]))
            p = pieces_of(code)
            own = learning[p.text]
            held[PIECE].append(_tallied(p.key[own] | WORD))
            stood = np.bincount(p.stood[own], minlength=5)
            stood[4] = learning.sum()  # ends of texts
            held[TOTAL].append((np.arange(5, dtype=np.uint64), stood))
            del code, p, marked, learnt
            words = wb.split_words(data, offsets, True)
            held[BASE].append(_tallied(words.hashes()[learning[words.row]]))
            if sum(len(x[0]) for some in held.values() for x in some) > MEMO:
                yield packed()
        yield packed()

    return run


def _merge(batches):
    """One row for each kind and part, of batches in that order."""
    for (kind, part), table in group_rows(batches, ["kind", "part"]):
        held = [(_keys_of(k), _numbers_of(n).view(np.int64)) for k, n in zip(*(table.column(c).to_pylist() for c in ("keys", "n")))]
        yield _counted([(kind, part, *_sum_up(held))])


def tallied(docs: DataFrame) -> tuple[DataFrame, int]:
    """kind, part, keys, n: all counts of docs(text, learning), a row for each
    kind and part; and how many parts. They grow with the bytes of text."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(max(24, size // PART_BYTES))
    counts = docs.select("text", "learning").mapInArrow(_tally(parts), COUNTED)
    merged = counts.repartition(parts, "part").sortWithinPartitions("kind", "part").mapInArrow(_merge, COUNTED)
    return cut(merged, "lm-counts"), parts


def _unpacked(batches):
    for batch in batches:
        for keys, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("keys", "n"))):
            yield pa.RecordBatch.from_arrays([pa.array(_keys_of(keys).view(np.int64)), pa.array(_numbers_of(n).view(np.int64))], names=["word", "n"])


def words_in(counts: DataFrame, kind: int) -> DataFrame:
    """word, n: the keys of a kind and their counts, a row each."""
    return counts.where(F.col("kind") == kind).mapInArrow(_unpacked, "word long, n long")


PACKED = "part int, grouped long, keys binary, numbers binary"


def _pack_words(batches):
    for batch in batches:
        part, keys, n = (batch.column(batch.schema.get_field_index(c)) for c in ("part", "keys", "n"))
        numbers = [_numbers_of(x).astype(np.float32).tobytes() for x in n.to_pylist()]
        yield pa.RecordBatch.from_arrays([part, pa.nulls(len(part), pa.int64()), keys, pa.array(numbers, pa.binary())], names=["part", "grouped", "keys", "numbers"])


class Taken(NamedTuple):
    """A run of texts, its symbols and pieces with the distinct ones' numbers."""

    batch: pa.RecordBatch
    code: np.ndarray
    pieces: Pieces
    grams: np.ndarray
    word_at: np.ndarray
    words: np.ndarray


def _take_apart(table: pa.Table, columns: list[str]) -> list[Taken]:
    out = []
    for batch in wb.text_chunks(table.select(columns).to_batches(), "text", CHUNK):
        code, _ = symbols(*wb.utf8(batch.column(batch.schema.get_field_index("text"))))
        p = pieces_of(code)
        out.append(Taken(batch, code, p, _tallied(code)[0], *_distinct(p.key | WORD)))
    return out


def _group_keys(taken: list[Taken]) -> np.ndarray:
    """Sorted distinct keys of a group's strings and words."""
    return _tallied(np.concatenate([x for t in taken for x in (t.grams, t.words)]))[0] if taken else np.zeros(0, np.uint64)


def _ask(parts: int):
    def run(key, table):
        keys = _group_keys(_take_apart(table, ["text"]))
        order, places = _packs(part_of(keys, parts), parts)
        keys = keys[order]
        return pa.table(
            {
                "part": pa.array([q for q, _, _ in places], pa.int32()),
                "grouped": pa.array([key[0].as_py()] * len(places), pa.int64()),
                "keys": pa.array([_keys_packed(keys[a:b]) for _, a, b in places], pa.binary()),
                "numbers": pa.nulls(len(places), pa.binary()),
            }
        )

    return run


def _answer(batches):
    """Numbers of the keys asked for; the table's rows of a part come first."""
    part, table, known, numbers = None, [], None, None
    for batch in batches:
        for q, grouped, keys, given in zip(*[c.to_pylist() for c in batch.columns]):
            if q != part:
                part, table, known = q, [], None
            if grouped is None:
                table.append((_keys_of(keys), np.frombuffer(given, np.float32)))
                continue
            if known is None:
                known, numbers = (np.concatenate(x) for x in zip(*table)) if table else (np.zeros(0, np.uint64), np.zeros(0, np.float32))
                order = np.argsort(known)
                known, numbers, table = np.append(known[order], wb.U(2**64 - 1)), np.append(numbers[order], np.float32(0)), []
            asked = _keys_of(keys)
            at = np.searchsorted(known, asked)
            found = np.where(known[at] == asked, numbers[at], np.float32(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([grouped], pa.int64()), pa.array([q], pa.int32()), pa.array([found.tobytes()])], names=["grouped", "part", "numbers"]
            )


def looked_up(model: Model, counts: DataFrame, parts: int, docs: DataFrame) -> DataFrame:
    """grouped, part, numbers: by group of docs(grouped, text) the costs of its
    strings and the counts of its words, in the order of _packs.

    Every part of the table is read by one task, which passes the groups'
    questions by; a group asks for a key once, however often it has it.
    """
    costs = counts.where(F.col("kind") == GRAM).mapInArrow(_costs(model), PACKED)
    known = costs.union(counts.where(F.col("kind") == PIECE).mapInArrow(_pack_words, PACKED))
    asked = docs.groupBy("grouped").applyInArrow(_ask(parts), PACKED)
    both = known.union(asked).repartition(parts, "part").sortWithinPartitions("part", F.col("grouped").asc_nulls_first())
    return both.mapInArrow(_answer, "grouped long, part int, numbers binary")


class Numbers:
    """A group's strings and words with their costs and counts."""

    def __init__(self, taken: list[Taken], numbers: pa.Table, parts: int):
        self.keys = _group_keys(taken)
        order, _ = _packs(part_of(self.keys, parts), parts)
        rows = sorted(zip(numbers.column("part").to_pylist(), numbers.column("numbers").to_pylist()))
        self.numbers = np.empty(len(order), dtype=np.float32)
        self.numbers[order] = np.concatenate([np.frombuffer(x, np.float32) for _, x in rows]) if rows else 0

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.numbers[np.searchsorted(self.keys, keys)]

    def of_symbols(self, code: np.ndarray) -> np.ndarray:
        """Costs of a run of symbols.

        A symbol has 48 bits; 2**16 at a time are sorted with their places below
        them, so that neighbours are looked up after one another.
        """
        out = np.empty(len(code), dtype=np.float32)
        place = np.arange(1 << 16, dtype=np.uint64)
        for a in range(0, len(code), 1 << 16):
            some = code[a : a + (1 << 16)]
            some = np.sort((some << wb.U(16)) | place[: len(some)])
            key = some >> wb.U(16)
            new = _new(key)
            out[a + (some & wb.U(0xFFFF)).astype(np.int64)] = self.of(key[new])[np.cumsum(new) - 1]
        return out


def steps_of(chance: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A chance's log2 odds against the bytes', 1 / FINENESS bits at a time.

    Rounded down, so what is mixed stays a probability; up to 31 bits over and
    not below 2**-32 times the bytes'.  The lowest step is chance 0.
    """
    with np.errstate(divide="ignore"):
        steps = np.floor((np.log2(chance) + bits) * FINENESS) + STEPS // 2
    return np.clip(steps, 0, STEPS - 1).astype(np.int32)


#: The odds of every step.
_ODDS = np.where(np.arange(STEPS) > 0, np.exp2((np.arange(STEPS) - STEPS // 2) / FINENESS), 0.0)


def odds_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gate, chances of bytes, dictionary, text and pair, relative to bytes)."""
    odds = np.ones((len(codes), 4))
    for j, unit in enumerate((STEPS**2, STEPS, 1), 1):
        odds[:, j] = _ODDS[codes // unit % STEPS]
    return codes // STEPS**3, odds


def fit_gate(scored: DataFrame) -> np.ndarray:
    """(gates, 4) shares of bytes, dictionary, text and pair, by EM over how
    often each combination stands in the training texts, where each word is
    taken out of its own count.

    There are at most WORD_GATES * STEPS**3 combinations, whatever the corpus's size.
    """

    def run(batches):
        for batch in batches:
            for codes, n in zip(*[c.to_pylist() for c in batch.columns]):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(codes, np.int32)), pa.array(np.frombuffer(n, np.int64))], names=["code", "n"])

    table = scored.where("fit_codes is not null").select("fit_codes", "fit_n").mapInArrow(run, "code int, n long")
    table = table.groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    mix = np.full((WORD_GATES, 4), 0.25)
    if not table.num_rows:
        mix[:] = (1, 0, 0, 0)
        return mix
    n = table.column("n").to_numpy().astype(np.float64)
    gate, chance = odds_of(table.column("code").to_numpy().astype(np.int64))
    for _ in range(25):
        part = mix[gate] * chance
        part *= (n / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        for j in range(4):
            mix[:, j] = np.bincount(gate, weights=part[:, j], minlength=WORD_GATES) + 0.5
        mix /= mix.sum(axis=1, keepdims=True)
    return mix


def _parts(batches, short: Counts):
    """(part, strings, n, counts) of each part."""
    for batch in batches:
        for part, keys, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "keys", "n"))):
            grams, n = _keys_of(keys), _numbers_of(n).view(np.int64)
            yield part, grams, n, Counts(grams[n > 0], n[n > 0], short)


def _shuffled(grams: np.ndarray, n: np.ndarray):
    """The strings of the training texts in an order by hash, so reruns agree."""
    grams, n = grams[n > 0], n[n > 0]
    order = np.argsort(wb.mix(grams))
    return grams[order], n[order]


def _learn(short: Counts):
    """Online mixer training over a part's grams; each step is one block.

    A gram's own occurrence is taken out of the counts that predict it.
    """

    def run(batches):
        for _, grams, n, counts in _parts(batches, short):
            grams, n = _shuffled(grams, n)
            weights = np.full((GATES, len(ORDERS) + 1), 0.3, dtype=np.float64)
            part = counts.of(grams)
            for a in range(0, len(grams), 4096):
                inputs, bits, n8 = _left_out(part, n, a, a + 4096)
                gate = _gate(inputs)
                x = np.einsum("gbi,gbi->gb", inputs, weights[gate])
                error = (bits - 1 / (1 + np.exp(-x))) * n8
                flat = gate.ravel()
                mass = np.bincount(flat, weights=np.broadcast_to(n8, gate.shape).ravel(), minlength=GATES) + STEADY
                for i in range(inputs.shape[2]):
                    step = np.bincount(flat, weights=(error * inputs[:, :, i]).ravel(), minlength=GATES)
                    weights[:, i] += RATE * step / mass
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([float(n.sum())])], names=["weights", "seen"])

    return run


def _left_out(part, n, a, b):
    ones, zeros, bits = part(a, b)
    up = bits[:, :, None] == 1
    one, zero = np.maximum(ones - up, 0), np.maximum(zeros - ~up, 0)
    return _inputs(log_odds(one, zero)), bits, n[a:b, None].astype(np.float64)


def _refining(short: Counts, weights):
    """Counts of (gate, bucket of the mixer's log-odds): weight and ones."""

    def run(batches):
        total, up = np.zeros(GATES * BUCKETS), np.zeros(GATES * BUCKETS)
        for _, grams, n, counts in _parts(batches, short):
            grams, n = grams[n > 0], n[n > 0]
            part = counts.of(grams)
            for a in range(0, len(grams), 16_384):
                inputs, bits, n8 = _left_out(part, n, a, a + 16_384)
                gate = _gate(inputs)
                low, share = _buckets(np.einsum("gbi,gbi->gb", inputs, weights[gate]))
                for at, mass in ((low, 1 - share), (low + 1, share)):
                    flat = (gate * BUCKETS + at).ravel()
                    total += np.bincount(flat, weights=(mass * n8).ravel(), minlength=len(total))
                    up += np.bincount(flat, weights=(mass * n8 * bits).ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total, up]).tobytes()])], names=["counts"])

    return run


def _costs(model: Model):
    """Strings with their costs, part by part."""

    def run(batches):
        for part, grams, _, counts in _parts(batches, model.short):
            numbers = bit_costs(model.weights, model.refine, counts, grams).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.array([_keys_packed(grams)]), pa.array([numbers.tobytes()])],
                names=["part", "grouped", "keys", "numbers"],
            )

    return run


def _short(batches):
    """gram, n: counts of the strings of SHORT + 1 bytes."""
    for batch in batches:
        for keys, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("keys", "n"))):
            keys, n = _sum_up([(_keys_of(keys) & Counts.mask(SHORT), _numbers_of(n).view(np.int64))])
            yield pa.RecordBatch.from_arrays([pa.array(keys[n > 0].astype(np.int64)), pa.array(n[n > 0].astype(np.int64))], names=["gram", "n"])


def train(counts: DataFrame) -> Model:
    """The mixer and its refinement, learnt on all strings of the training texts; none gives even odds."""
    strings = counts.where(F.col("kind") == GRAM)
    table = strings.mapInArrow(_short, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    short = Counts(table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy())
    short.tables = {order: short.tables[order] for order in ORDERS if order <= SHORT}
    shape = (GATES, len(ORDERS) + 1)
    learnt = strings.mapInArrow(_learn(short), "weights binary, seen double").where("seen > 0").orderBy("weights").toArrow().to_pylist()
    mass = sum(r["seen"] for r in learnt)
    weights = sum((np.frombuffer(r["weights"]).reshape(shape) * (r["seen"] / mass) for r in learnt), np.zeros(shape))
    weights = (weights if learnt else np.full(shape, 0.3)).astype(np.float32)
    sums = sum(
        (np.frombuffer(r["counts"]) for r in strings.mapInArrow(_refining(short, weights), "counts binary").toArrow().to_pylist()),
        np.zeros(2 * GATES * BUCKETS),
    )
    total, up = sums.reshape(2, GATES, BUCKETS)
    center = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
    rate = (up + 4 * center) / (total + 4)
    return Model(short, weights, np.log(rate / (1 - rate)).astype(np.float32))


SCORED = (
    "doc_id long, key long, n_bytes long, bits double, codes binary, n_tokens long, n_known long, base double, rare array<long>, "
    "fit_codes binary, fit_n binary"
)


def _score(totals: np.ndarray, frequent: np.ndarray, counts: np.ndarray, ends: int, parts: int):
    """By text the bits of its bytes, its pieces' combinations, and the base's
    sum; words not among `frequent` (sorted) are handed on.  The combinations
    that the gate is fitted to, of the training texts, are counted beside them."""

    def rows(table: pa.Table, numbers: pa.Table):
        logs = np.log10(counts + 1.0)
        taken = _take_apart(table, ["doc_id", "text", "key", "learning"])
        known, fitted = Numbers(taken, numbers, parts), []
        while taken:
            batch, code, p, _, word_at, words = taken.pop()
            bits = np.add.reduceat(known.of_symbols(code), p.start).astype(np.float64)
            n_words = known.of(words)[word_at].astype(np.float64)
            own, pair, gate = own_chances(p)
            late = steps_of(own, bits) * STEPS + steps_of(pair, bits)
            gate = gate.astype(np.int32) * STEPS
            codes = (gate + steps_of(dictionary_chance(p, n_words, totals), bits)) * STEPS**2 + late
            learning = batch.column(3).to_numpy(zero_copy_only=False)[p.text]
            fit = ((gate + steps_of(dictionary_chance(p, n_words, totals, 1), bits)) * STEPS**2 + late)[learning]
            fitted.append(_tallied(fit))
            edge = np.searchsorted(p.text, np.arange(batch.num_rows + 1))
            total = np.bincount(p.text, weights=bits, minlength=batch.num_rows)
            blobs = [codes[a:b].tobytes() for a, b in zip(edge, edge[1:])]
            # before the next arrays of a run's size
            del code, p, word_at, own, pair, gate, bits, n_words, codes, learning, late, fit
            data, offsets = wb.utf8(batch.column(1))
            words = wb.split_words(data, offsets, True)
            h, row = words.hashes(), words.row
            at, distinct = _distinct(h)
            place = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
            hit, place = (frequent[place] == distinct)[at], place[at]
            size = np.diff(words.first)
            base = np.bincount(row[hit], weights=logs[place[hit]], minlength=len(size)) + np.log10(ends + 1.0)
            found = np.bincount(row[hit], minlength=len(size)) + int(ends > 0)
            rare = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row[~hit], np.arange(len(size) + 1)).astype(np.int32)), pa.array(h[~hit].astype(np.int64))
            )
            fit = [x.tobytes() for x in _sum_up(fitted)] if not taken else [None] * 2  # a group's, with its last run
            nothing = [None] * (len(size) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    *map(pa.array, (np.diff(offsets), total)),
                    pa.array(blobs, pa.binary()),
                    *map(pa.array, (size + 1, found, base)),
                    rare,
                    *(pa.array([x, *nothing], pa.binary()) for x in fit),
                ],
                names=["doc_id", "key", "n_bytes", "bits", "codes", "n_tokens", "n_known", "base", "rare", "fit_codes", "fit_n"],
            )

    def run(table: pa.Table, numbers: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(rows(table, numbers)))

    return run


def _mixed(mix: np.ndarray):
    """Bits of each text: what its bytes cost, less what the words save."""

    def run(batches):
        for batch in batches:
            bits = batch.column(3).to_numpy().copy()
            for i, blob in enumerate(batch.column(2).to_pylist()):
                gate, odds = odds_of(np.frombuffer(blob, np.int32).astype(np.int64))
                bits[i] -= np.log2((mix[gate] * odds).sum(axis=1)).sum()
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bits), *batch.columns[4:]], names=["doc_id", "key", "bits", *batch.schema.names[4:]])

    return run


def held_out_rows(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, held_out=held_out_rows) -> DataFrame:
    """Score every whole text of docs; learn from those not held_out(doc_id).

    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens seen
    in training), train_tokens, base_score (log10 under add-one word counts),
    score (log10 probability of the text's bytes and end under the mixing
    model), n_bytes and bits_per_byte (null for an empty text).  Null texts are
    empty; an empty text still has its end.  Repeated rows stay, and each counts
    as a training text; so does a row without doc_id.  Further columns are
    ignored.  An empty table gives an empty one; without training text all
    bytes are even odds.
    """
    docs = texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("learning", ~held_out(F.col("doc_id")))
    counts, parts = tallied(docs)
    model = train(counts)
    totals = np.zeros(5)
    for r in words_in(counts, TOTAL).collect():
        totals[r["word"]] = r["n"]
    ends = int(totals[4])  # the end's count; it needs no place among the frequent words
    vocabulary = words_in(counts, BASE)
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    top = most_frequent(vocabulary, FREQUENT_WORDS).toArrow()
    frequent = top.column("word").to_numpy().astype(np.uint64)
    order = np.argsort(frequent)
    frequent, often = np.append(frequent[order], wb.U(2**64 - 1)), np.append(top.column("n").to_numpy()[order], 0)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    docs = docs.withColumn("key", F.xxhash64("text"))
    docs = docs.withColumn("grouped", F.pmod(F.xxhash64("doc_id", "key"), F.lit(size // GROUP_BYTES + 1)))
    numbers = looked_up(model, counts, parts, docs)  # in one plan with the scores, so that texts are shuffled once
    scored = docs.groupBy("grouped").cogroup(numbers.groupBy("grouped")).applyInArrow(_score(totals[:4], frequent, often, ends, parts), SCORED)
    scored = cut(scored, "lm-scored", "zstd")
    rare = scored.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.explode("rare").alias("word")).groupBy("doc_id", "key", "word").count()
    more = (
        rare.join(vocabulary, "word")
        .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("rare_key"))
        .agg(F.sum(F.col("count") * F.log10(F.col("n") + 1)).alias("more"), F.sum("count").alias("more_known"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("rare_key"))
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    scored = scored.select("doc_id", "key", "codes", "bits", "n_bytes", "n_tokens", "n_known", "base").mapInArrow(
        _mixed(fit_gate(scored)), "doc_id long, key long, bits double, n_bytes long, n_tokens long, n_known long, base double"
    )
    return scored.join(more, same, "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (-F.col("bits") * F.log10(F.lit(2.0))).alias("score"),
        "n_bytes",
        F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op3_lm_scoring(spark, sf_dir):
    return score_texts(documents(spark, sf_dir))
