"""Tiled joins of vectors and of entities against all pairs."""

import itertools
import random

import numpy as np
import pytest

from folio.operators import graph as g
from folio.operators import vectors as v


def vectors(spark, n=600, copies=40):
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(8, 16))
    x = (centers[rnd.integers(0, 8, n)] + 0.4 * rnd.normal(size=(n, 16))).astype(np.float32)
    x[100 : 100 + copies] = x[100]  # ties
    x[7] = 0
    labels = np.where(rnd.random(n) < 0.5, 0, rnd.integers(0, 5, n))  # half have one label
    return x, labels, spark.createDataFrame([(i, int(labels[i]), x[i].tolist()) for i in range(n)], "vec_id long, label int, embedding array<float>")


def cosines(x):
    unit = x.astype(float) / np.maximum(np.linalg.norm(x.astype(float), axis=1, keepdims=True), 1e-12)
    return unit @ unit.T


@pytest.mark.parametrize(("rows", "queries", "pivots"), [(8192, 16384, 64), (50, 3, 9), (10_000, 10_000, 1)])
def test_nearest_has_recall_one(spark, monkeypatch, rows, queries, pivots):
    """Every id divisible by 50 against all rows: the same ids in the same order."""
    for name, value in (("TILE_ROWS", rows), ("TILE_QUERIES", queries), ("PIVOTS", pivots)):
        monkeypatch.setattr(v, name, value)
    x, _, df = vectors(spark)
    s = np.round(cosines(x), 9)
    got = {(r.query_id, r.rank): r.vec_id for r in v.nearest(df, df.where("vec_id % 50 = 0"), 5).collect()}
    for q in range(0, len(x), 50):
        best = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[q, i], i))[:5]
        assert [got[q, k] for k in range(1, 6)] == best, q
    assert len(got) == 5 * 12


def test_nearest_of_few_and_none(spark):
    df = spark.createDataFrame([(0, 1, [1.0, 0.0]), (50, 1, [0.0, 1.0]), (3, 2, [1.0, 1.0])], "vec_id long, label int, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in v.nearest(df, df.where("vec_id % 50 = 0"), 5).collect())
    assert got == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert v.nearest(df.limit(0), df.limit(0), 5).collect() == []


@pytest.mark.parametrize(("rows", "queries"), [(8192, 16384), (40, 2)])
def test_within_a_label(spark, monkeypatch, rows, queries):
    monkeypatch.setattr(v, "TILE_ROWS", rows)
    monkeypatch.setattr(v, "TILE_QUERIES", queries)
    x, labels, df = vectors(spark)
    s = cosines(x)
    expected = {(q, i) for q in range(0, len(x), 50) for i in range(len(x)) if i != q and labels[i] == labels[q] and s[q, i] >= 0.3}
    assert {(r.query_id, r.vec_id) for r in v.within(df, df.where("vec_id % 50 = 0"), 0.3).collect()} == expected


def mentions(spark):
    rnd = random.Random(6)
    kinds = ["EMAIL", "NUMBER", "PERSON"]
    rows = [(doc, k := rnd.choice(kinds), f"{k}:{rnd.randrange(60)}") for doc, n in ((1, 400), (2, 3), (3, 1), (4, 60)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "document_id long, entity_type string, canonical_id string")


@pytest.mark.parametrize("part", [512, 7])
def test_cooccurrence_in_parts(spark, part):
    rows, df = mentions(spark)
    by = {}
    for doc, _, name in rows:
        by.setdefault(doc, set()).add(name)
    expected = sorted((doc, a, z) for doc, names in by.items() for a, z in itertools.combinations(sorted(names), 2))
    got = g.cooccurrence(df, part).collect()
    assert sorted((r.document_id, r.source_id, r.target_id) for r in got) == expected
    counts = {}
    for _, a, z in expected:
        key = a.split(":")[0], z.split(":")[0]
        counts[key] = counts.get(key, 0) + 1
    assert {(r.type1, r.type2): r.edges for r in g.cooccurrence_counts(df).collect()} == counts


def test_a_large_document_is_many_tasks(spark):
    """A document of 20,000 entities: counted without its pairs, and its pairs dealt out."""
    df = spark.range(20_000).selectExpr("1L as document_id", "'PERSON' as entity_type", "concat('PERSON:', id) as canonical_id")
    assert [(r.edges) for r in g.cooccurrence_counts(df).collect()] == [20_000 * 19_999 // 2]
    pairs = g.cooccurrence(df.where("hash(canonical_id) % 4 = 0"), 100)
    rows = pairs.groupBy("document_id").count().collect()
    n = df.where("hash(canonical_id) % 4 = 0").count()
    assert rows[0]["count"] == n * (n - 1) // 2
