"""Line deduplication by winnowing over line hashes (operator 1).

Every window of consecutive lines selects its smallest line hash as fingerprint.
Equal runs of a window's length have equal windows and so equal fingerprints;
fingerprints found elsewhere are joined by position, extended line by line in
both directions, and later copies of repeated runs are deleted.  A line of many
words is a run by itself.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, spare, texts

#: Lines in a window: runs at least this long are found without fail.
RUN = 3
#: Words that make a single line a run.
LONG_LINE = 12
PLACE = "print long, doc_id long, key long, line int, around array<long>"

_SPACES = np.array([b in (32, 9, 10, 11, 12, 13) for b in range(256)])


class Lines(NamedTuple):
    """Solid (not blank) lines of a run of texts, without white space at their ends."""

    hashes: np.ndarray
    first: np.ndarray  # index of each text's first line; one more at the end
    number: np.ndarray  # line number in its text, blank lines counted
    words: np.ndarray  # words of the line


def _lines(column) -> Lines:
    data, offsets = wb.utf8(column)
    breaks = np.zeros(256, dtype=bool)
    breaks[10] = True
    lines = wb.split_words(data, offsets, False, breaks)
    inside = ~_SPACES[data]
    solid_at = np.flatnonzero(inside)
    before = np.zeros(len(data) + 1, dtype=np.int64)  # bytes that are not white space
    np.cumsum(inside, out=before[1:])
    solid = before[lines.end] > before[lines.begin]
    begin = solid_at[before[lines.begin[solid]]] if len(solid_at) else lines.begin[solid]
    end = solid_at[before[lines.end[solid]] - 1] + 1 if len(solid_at) else lines.end[solid]
    breaks_before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 10, out=breaks_before[1:])
    row = lines.row[solid]
    number = breaks_before[begin] - breaks_before[offsets[:-1]][row]
    starts = np.zeros(len(data) + 1, dtype=np.int64)  # bytes that begin a word
    if len(data):
        np.cumsum(inside & np.concatenate(([True], ~inside[:-1])), out=starts[1:])
    # a line's first byte begins a word, also where it is the text's first byte
    words = starts[end] - starts[np.minimum(begin + 1, len(data))] + 1
    return Lines(lines.hashes(begin, end), np.searchsorted(row, np.arange(len(column) + 1)), number, words)


def _windows(run: int, long_line: int):
    """Each text's selected fingerprints with the lines around them: 2 * run - 1
    of them, 0 where the text ends; just the line itself for a long line."""

    def task(batches):
        for batch in wb.text_chunks(batches, "text"):
            lines = _lines(batch.column(1))
            h, first = lines.hashes, lines.first
            count = np.maximum(np.diff(first) - run + 1, 0)
            row = np.repeat(np.arange(len(count)), count)
            begin = first[row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place, best = begin.copy(), h[begin]
            for j in range(1, run):  # the leftmost minimum of each window
                lower = h[begin + j] < best
                best, place = np.where(lower, h[begin + j], best), np.where(lower, begin + j, place)
            new = np.ones(len(place), dtype=bool)
            new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
            place, row = place[new], row[new]
            at = place[:, None] + np.arange(1 - run, run)[None, :]
            out_of_text = (at < first[row][:, None]) | (at >= first[row + 1][:, None])
            around = np.where(out_of_text, wb.U(0), h[np.clip(at, 0, max(len(h) - 1, 0))]) if len(place) else np.zeros((0, 2 * run - 1), np.uint64)
            alone = np.flatnonzero(lines.words >= long_line)
            alone_row = np.searchsorted(first, alone, "right") - 1
            width = np.concatenate([np.full(len(place), 2 * run - 1), np.ones(len(alone), np.int64)])
            rows = np.concatenate([row, alone_row])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h[place], wb.mix(h[alone])]).astype(np.int64)),
                    batch.column(0).take(pa.array(rows)),
                    batch.column(2).take(pa.array(rows)),
                    pa.array((np.concatenate([place, alone]) - first[rows]).astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(width))).astype(np.int32)),
                        pa.array(np.concatenate([around.ravel(), h[alone]]).astype(np.int64)),
                    ),
                ],
                names=["print", "doc_id", "key", "line", "around"],
            )

    return task


def repeated_runs(docs: DataFrame, run: int = RUN, long_line: int = LONG_LINE) -> DataFrame:
    """doc_id, key, start, lines: runs that also stand earlier, in a smaller
    (doc_id, key) or further up in the same text; start counts non-blank lines.

    docs has doc_id, text and key, a hash of the text.  A run is `run` lines, or
    one line of long_line or more words.  Only fingerprints with two or more
    places go on to be joined.  Extension both ways: the lines from run - 1
    before to run - 1 after a fingerprint are all windows it can have been
    selected by, so each of them is looked up together with its lines.  A
    window's first place is the minimum over its copies, taken before anything
    is joined, so a run with very many copies costs one row for each copy and no
    pairs.  Both aggregates are written before they are joined, so that a join
    can be split where a fingerprint or a run is hot.
    """
    places = cut(docs.mapInArrow(_windows(run, long_line), PLACE), "lines-places")
    here = F.struct("doc_id", "key", "line")
    shared = places.groupBy("print").agg(F.min(here).alias("low"), F.max(here).alias("high")).where("low < high").select("print")
    places = places.join(cut(shared, "lines-shared"), "print")
    alone = F.size("around") == 1
    shift = F.explode(F.sequence(F.lit(0), F.when(alone, 0).otherwise(run - 1))).alias("shift")  # lines of the window before the fingerprint
    windows = places.select("doc_id", "key", "line", "around", shift).select(
        "doc_id",
        "key",
        "shift",
        F.when(alone, F.col("around")).otherwise(F.slice("around", F.lit(run) - F.col("shift"), F.lit(run))).alias("lines"),
        (F.col("line") - F.col("shift")).alias("start"),
    )
    # the fingerprint must be the window's own minimum, as unsigned numbers (leftmost on ties)
    unsigned = F.transform("lines", lambda x: x.bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    own = F.array_position(unsigned, F.array_min(unsigned)) == F.col("shift") + 1
    windows = windows.where(~F.array_contains("lines", F.lit(0).cast("long")) & own).select(
        F.xxhash64("lines").alias("one"),
        F.xxhash64(F.size("lines"), "lines", F.lit(7)).alias("two"),
        "doc_id",
        "key",
        "start",
        F.size("lines").alias("lines"),
    )
    here = F.struct("doc_id", "key", "start")
    first = windows.groupBy("one", "two").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first < last").drop("last")
    found = windows.join(cut(first, "lines-first"), ["one", "two"]).where(F.col("first") < here)
    return found.select("doc_id", "key", "start", "lines")


def _starts(docs: DataFrame, run: int, long_line: int) -> DataFrame:
    runs = repeated_runs(docs, run, long_line)
    return runs.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "lines")).alias("starts"))


def _shorten(column, starts: list) -> tuple[list[int], list[int], list]:
    """(lines, deleted lines, text that is kept) of each text."""
    lines = _lines(column)
    count, gone, kept = [], [], []
    for i, (text, runs) in enumerate(zip(column.to_pylist(), starts)):
        count.append(text.count("\n") + 1 if text else 0)
        if not runs:
            gone.append(0)
            kept.append(text)
            continue
        numbers = lines.number[lines.first[i] : lines.first[i + 1]]
        drop = {n for r in runs for n in numbers[r["start"] : r["start"] + r["lines"]].tolist()}
        gone.append(len(drop))
        kept.append("\n".join([line for j, line in enumerate(text.split("\n")) if j not in drop]))
    return count, gone, kept


def _delete(batches):
    for batch in wb.text_chunks(batches, "text"):
        count, gone, kept = _shorten(batch.column(1), batch.column(2).to_pylist())
        digest = [hashlib.sha256((text or "").encode()).hexdigest() for text in kept]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(digest)],
            names=["doc_id", "n_lines", "n_removed", "kept_text", "kept_sha256"],
        )


def dedup_lines(docs: DataFrame, run: int = RUN, long_line: int = LONG_LINE) -> DataFrame:
    """Delete every line that lies in a run standing earlier.

    A run is `run` lines, or one line of long_line or more words.  Earlier: in a
    smaller doc_id, or further up in the same text.  Lines end at \\n and are
    compared without white space at their ends; blank lines are passed over when
    runs are formed and are always kept.  Runs are judged on the input, so of
    all copies of a run just the first stays.  Returns one row per row of docs:
    doc_id, n_lines, n_removed, kept_text, kept_sha256.  A null or empty text
    has no lines.  Rows that share a doc_id but not their text are ordered by a
    hash of the text, and each loses its own lines only; rows that repeat both
    are one and come out alike.  Rows without a doc_id lose nothing, and delete
    nothing.  Further columns are ignored.
    """
    docs = texts(docs).withColumn("key", F.xxhash64("text"))
    known = docs.where("doc_id is not null")
    rest = docs.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<struct<start int, lines int>>").alias("starts"))
    return (
        known.join(_starts(known, run, long_line), ["doc_id", "key"], "left")
        .select("doc_id", "text", "starts")
        .union(rest)
        .mapInArrow(_delete, "doc_id long, n_lines long, n_removed long, kept_text string, kept_sha256 string")
    )


def _replace(batches):
    """Rows as they are, with the text that is kept; starts are the last column."""
    for batch in wb.text_chunks(batches, "text"):
        names = batch.schema.names[:-1]
        text = pa.array(_shorten(batch.column(names.index("text")), batch.column(len(names)).to_pylist())[2], pa.string())
        columns = {n: batch.column(i) for i, n in enumerate(names)} | {"text": text}
        if "n_chars" in columns:
            columns["n_chars"] = pa.compute.utf8_length(text).cast(columns["n_chars"].type)
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def without_repeated_lines(docs: DataFrame, run: int = RUN, long_line: int = LONG_LINE) -> DataFrame:
    """docs with repeated runs of lines deleted from text (n_chars follows).

    As dedup_lines; all rows and columns stay, whatever the columns are called.
    """
    own_id, own_key, starts = (spare(docs.columns, name) for name in ("_id", "_key", "_starts"))
    runs = _starts(texts(docs).withColumn("key", F.xxhash64("text")).where("doc_id is not null"), run, long_line)
    runs = runs.select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key), F.col("starts").alias(starts))
    same = (F.col("doc_id").cast("long") == F.col(own_id)) & (F.xxhash64("text") == F.col(own_key))
    return docs.join(runs, same, "left").drop(own_id, own_key).mapInArrow(_replace, docs.schema)


def op1_line_dedup(spark, sf_dir):
    return dedup_lines(documents(spark, sf_dir)).drop("kept_text")
