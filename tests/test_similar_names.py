"""The similarity join of names against all pairs, and how many pairs it tries."""

import collections
import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folio.operators import resolve as r

SCHEMA = "entity_type string, canonical_id string, name string"


def distance(a, z):
    row = list(range(len(z) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(z, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def all_pairs(rows, percent):
    rows = {row for row in rows if None not in row}
    return sorted(
        (kind, i, j, distance(a, z))
        for (kind, i, a), (other, j, z) in itertools.product(rows, rows)
        if kind == other and i < j and 100 * distance(a, z) <= (100 - percent) * max(len(a), len(z))
    )


def edited(rnd, name, edits):
    letters = list(name)
    for _ in range(edits):
        at = rnd.randrange(len(letters) + 1)
        letters[at : at + rnd.randrange(2)] = rnd.choice(["", "ä", "b", "𝒳"])
    return "".join(letters)


def given():
    """Names of all lengths to 45 with edits, repeats and a common ending; ids with
    several names, names with several ids, and nulls."""
    rnd = random.Random(4)
    rows = [("A", "x", None), ("A", None, "abc"), (None, "x", "abc"), ("A", "x", "a"), ("A", "y", "a"), ("A", "z", ""), ("A", "w", ""), ("B", "x", "a")]
    for n in [*range(2, 24), 30, 37, 45] * 2:
        name = "".join(rnd.choice("abc") for _ in range(n))
        ending = rnd.choice(["", "@mail.example.com"])
        for e in (0, 1, n // 5, n // 4):
            rows.append((rnd.choice("AAB"), f"{rnd.randrange(300)}", edited(rnd, name, e) + ending))
    return rows + [("A", f"r{i}", "a" * i + "b" * (i % 3)) for i in range(15, 33)]


@pytest.mark.parametrize(("percent", "part", "keys"), [(80, 2048, 1024), (80, 5, 1024), (80, 7, 0), (65, 5, 200), (50, 2048, 1024), (100, 5, 1024)])
def test_all_similar_pairs(spark, monkeypatch, percent, part, keys):
    monkeypatch.setattr(r, "PART", part)
    monkeypatch.setattr(r, "KEYS", keys)
    rows = given()
    got = r.similar_names(spark.createDataFrame(rows, SCHEMA).distinct(), percent)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "bigint"]
    expected = all_pairs(rows, percent)
    assert sorted(map(tuple, got.collect())) == expected
    assert len(expected) > 10


def test_nothing_is_similar_to_nothing(spark):
    assert r.similar_names(spark.createDataFrame([], SCHEMA)).collect() == []


def test_names_of_common_syllables_make_few_pairs():
    """Names that share all their grams with thousands of others meet few of them."""
    rnd = random.Random(8)
    syllables = "the he in er an re on at en nd ti es or te of ed is it al ar".split()
    names = sorted({"".join(rnd.choice(syllables) for _ in range(rnd.randrange(4, 6))) for _ in range(20_000)})
    batch = pa.RecordBatch.from_arrays([pa.array(["P"] * len(names)), pa.array(names), pa.array(names)], names=["entity_type", "canonical_id", "name"])
    group = collections.defaultdict(set)
    for out in r._shortened(80, 20)([batch]):
        for key, name in zip(out.column("key").to_pylist(), out.column("name").to_pylist()):
            group[key].add(name)
    tried = sum(len(g) * (len(g) - 1) // 2 for g in group.values())
    assert len(names) > 15_000 and tried < 40 * len(names)  # of 7,000 * len(names)


def test_a_common_ending_is_met_once(spark):
    """Names with one ending, in several parts: each pair is found once, and all are."""
    rows = [("A", f"{i}", f"{i * 7919 % 10007:05d}@mail.example.com") for i in range(300)]
    got = r.similar_names(spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lower("name")))
    assert sorted(map(tuple, got.collect())) == all_pairs(rows, 80)
