"""What the substring operator hands on between the parts of a hot passage, and what it leaves on disk."""

import collections
import pathlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folio.llm import common
from folio.llm import substring_dedup as sd
from folio.llm import wordblocks as wb
from tests.llm.test_operators import brute_windows, make


def _documents(n):
    """One passage in words of each document's own, exact copies and near copies."""
    rnd = random.Random(8)
    own = lambda k: " ".join(f"u{rnd.randrange(10**9)}" for _ in range(k))
    passage, text = own(16), own(60).split()
    near = [" ".join(text[: 7 + i % 40] + [own(1)] + text[8 + i % 40 :]) for i in range(n)]
    return list(enumerate([x for i in range(n) for x in (f"{own(25)} {passage} {own(25)}", " ".join(text), near[i])]))


def _handed_on(spark, monkeypatch, rows):
    """(windows that the parts handed on, by document; the words that went)."""
    kept = {}
    with monkeypatch.context() as patch:
        patch.setattr(sd, "cut", lambda df, name: kept.setdefault(name, common.cut(df, name)))
        docs = make(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("key"))
        gone = collections.defaultdict(set)
        for r in sd.removed_spans(docs, per_shard=3).collect():
            gone[r.doc_id] |= set(range(r.start, r.stop))
    return kept, gone


def test_parts_hand_on_windows_of_their_own_seeds(spark, monkeypatch):
    number = {}
    for n in (10, 20):
        rows = _documents(n)
        kept, gone = _handed_on(spark, monkeypatch, rows)
        expected = brute_windows(rows)
        assert all(len(gone[i]) == expected[i, x][1] for i, x in rows)
        shared = {r.seed for r in kept["substring-seeds"].collect()}
        windows = 0
        for r in kept["substring-matched"].where("words is not null").collect():
            words = np.frombuffer(r.words, np.uint64)
            runs, _ = wb.grams(words, np.array([0, len(words)]), sd.SEED)
            for j in range(len(words) - sd.WINDOW + 1):  # a window that selects a seed of no other document can't stand in one
                assert int(runs[j : j + 9].min().astype(np.int64)) in shared
                windows += 1
        number[n] = windows
    assert 0 < number[20] <= 2.2 * number[10]  # with the group's size, not its square


def test_a_run_hands_a_repeated_window_on_once(spark, monkeypatch):
    """Junk of two words over and over: two windows, each with all its places."""
    words = np.array([7, 9] * 300, np.uint64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([2]), pa.array([50], pa.int32()), pa.array([None], pa.int32()), pa.array([words.tobytes()], pa.binary())],
        names=["doc_id", "key", "start", "stop", "words"],
    )
    (found,) = sd._fresh_windows(sd.WINDOW)(iter([batch]))
    assert found.num_rows == 2 and sorted(sum(found["starts"].to_pylist(), [])) == list(range(50, 50 + 588))
    rows = [(i, "a b " * (40 + i)) for i in range(30)]
    _, gone = _handed_on(spark, monkeypatch, rows)
    expected = brute_windows(rows)
    assert all(len(gone[i]) == expected[i, x][1] for i, x in rows)


def test_cut_leaves_no_shuffle_files(spark):
    files = lambda: {p for p in pathlib.Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}
    before = files()
    table = common.cut(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "some")
    assert files() <= before and spark.conf.get(common.SHUFFLE_CLEANUP) == "false"
    assert table.agg(F.sum("count")).first()[0] == 5000
