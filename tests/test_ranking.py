"""Distributed places against sorted lists."""

import random

from folio.operators.ranking import numbered


def test_places_by_key(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None, "c"]), rnd.choice([None, *range(500)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long, i long")
    got = sorted(numbered(df, ["k"], ["v", "i"], "place", "n").collect(), key=lambda r: r.i)
    order = lambda r: ((r[1] is not None, r[1] or 0), r[2])
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=order)
        assert [got[r[2]].place for r in own] == list(range(len(own))) and {got[r[2]].n for r in own} == {len(own)}


def test_places_without_key_and_of_nothing(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as v")
    assert all(r.v == r.rank for r in numbered(df, [], ["v"]).collect())
    assert numbered(df.where("v < 0"), [], ["v"]).collect() == []


def test_no_window_over_a_key(spark):
    plan = numbered(spark.range(1000).selectExpr("id % 2 as k", "id"), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
