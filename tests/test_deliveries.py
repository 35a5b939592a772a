"""Streams whose events come late, twice and in any order; tables that lose old partitions."""

import collections
import datetime
import random

from pyspark.sql import functions as F

from folio.operators import extract as x
from folio.operators import graph as g
from folio.operators import metrics as m
from folio.sources import storage as s
from folio.streaming import streams as st

EVENTS = "document_id long, event_id long, status string, ts timestamp"


def gate(events):
    """{document: (failures since the last success, when the last was)} of all events in order."""
    out = {}
    for doc, i, status, ts in sorted(events, key=lambda e: (e[3], e[1])):
        n, last = out.get(doc, (0, None))
        out[doc] = (n + 1, ts) if status == "failed" else (0, None) if status == "completed" else (n, last)
    return out


def test_gates_of_shuffled_deliveries(spark):
    rnd = random.Random(9)
    t0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    events = [(rnd.randrange(6), i, rnd.choice(["failed", "failed", "started", "completed"]), t0 + datetime.timedelta(minutes=rnd.randrange(0, 240, 5))) for i in range(300)]
    events += [(7, 1000, "failed", t0), (7, 1001, "completed", t0), (7, 1002, "failed", t0)]  # equal times: by event_id
    rnd.shuffle(events)
    parts = [spark.createDataFrame(events[i::4], EVENTS) for i in range(4)]
    got = {r.document_id: (r.failures, r.last_us) for r in st.latest_gates(st.delivered(parts, lambda e: st.failure_gate(e, "5 hours"), "update", "t")).collect()}
    assert got == {d: (n, int(last.timestamp() * 1e6) if n else 0) for d, (n, last) in gate(events).items()}
    assert got[7][0] == 1


def test_gates_settle_behind_the_watermark(spark):
    """Hour-wise deliveries within a watermark of two hours: held events are few and all count; one later than that doesn't."""
    t0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    at = lambda minutes: t0 + datetime.timedelta(minutes=minutes)
    first = [(1, i, "failed", at(10 * i)) for i in range(5)]
    second = [(1, 10, "failed", at(300)), (2, 11, "failed", at(305))]
    late = [(1, 12, "completed", at(200)), (2, 13, "failed", at(250))]
    too_late = [(1, 14, "completed", at(5)), (2, 15, "started", at(600))]
    parts = [spark.createDataFrame(p, EVENTS) for p in (first, second, late, too_late)]
    got = {r.document_id: (r.failures, r.last_us) for r in st.latest_gates(st.delivered(parts, lambda e: st.failure_gate(e, "2 hours"), "update", "t")).collect()}
    us = lambda minutes: int(at(minutes).timestamp() * 1e6)
    assert got == {1: (1, us(300)), 2: (2, us(305))}


def test_first_deliveries_across_batches(spark):
    """A copy in a later batch is dropped by the state of an earlier one; one after its key was let go counts as new."""
    at = lambda minutes: datetime.datetime.fromtimestamp(1_700_000_000 + 60 * minutes, datetime.timezone.utc)
    sent = [[("a", 0), ("b", 1)], [("a", 20), ("c", 30)], [("z", 200)], [("a", 205), ("b", 10), ("z", 206)]]
    parts = [spark.createDataFrame([(k, n, at(t)) for k, t in rows], "key string, delivery int, ts timestamp") for n, rows in enumerate(sent)]
    once = st.delivered(parts, lambda e: st.first_deliveries(e, ["key"]).select("key", "delivery"), "append", "t")
    assert sorted((r.key, r.delivery) for r in once.collect()) == [("a", 0), ("a", 3), ("b", 0), ("c", 1), ("z", 2)]


def daily(spark, path):
    df = spark.range(240).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) as ts").withColumn("day", F.to_date("ts"))
    df.write.partitionBy("day").parquet(path)
    return "id long, ts timestamp, day date"


def test_retire_moves_whole_partitions(spark, tmp_path):
    path, archive = f"{tmp_path}/t", f"{tmp_path}/a"
    schema = daily(spark, path)
    moved = s.retire(spark, path, archive, "day", "2024-01-04")
    assert moved == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert s.partition_values(spark, archive, "day") == moved and len(s.partition_values(spark, path, "day")) == 7
    ids = lambda p: sorted(r.id for r in spark.read.schema(schema).parquet(p).collect())
    assert ids(archive) == list(range(72)) and ids(path) == list(range(72, 240))
    assert s.retire(spark, path, archive, "day", "2024-01-04") == []  # again: nothing more
    s.retire(spark, path, archive, "day", "2024-01-05")  # the archive keeps what it has
    assert ids(archive) == list(range(96)) and ids(path) == list(range(96, 240))


def test_prune_rewrites_the_day_it_cuts(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = daily(spark, path)
    bar = datetime.datetime(2024, 1, 3, 6)
    assert s.prune(spark, path, "day", "ts", bar, dry_run=True) == 54
    assert spark.read.schema(schema).parquet(path).count() == 240
    assert s.prune(spark, path, "day", "ts", bar) == 54
    assert sorted(r.id for r in spark.read.schema(schema).parquet(path).collect()) == list(range(54, 240))
    assert s.prune(spark, path, "day", "ts", bar) == 0


def test_rows_checked_against_a_schema(spark):
    lines = ['{"a": 1, "b": "x"}', '{"a": "one", "b": "x"}', '{"b": "x"}', '{"a": 1, "b"', "", "[1]", '{"a": null, "b": "x"}', '{"a": -5, "b": "x"}', '{"a": 1, "b": "x", "more": 3}', None]
    rows = s.checked(spark.createDataFrame([(x,) for x in lines], "value string"), "a long, b string", {"positive": "a > 0"})
    got = [(r.errors, r.corrupt) for r in rows.collect()]
    assert [e for e, _ in got] == [[], ["type: a"], ["missing: a"], ["malformed"], ["malformed"], ["malformed"], ["missing: a"], ["rule: positive"], [], ["malformed"]]
    assert got[1][1] == lines[1] and got[0][1] is None
    report = {r.name: (r.n, round(r.share, 6), r.fix) for r in s.validation_report(rows, "t").collect()}
    assert report == {"all": (10, 100, ""), "valid": (2, 20, ""), "invalid": (8, 80, ""), "type: a": (1, 10, "convert a"), "missing: a": (2, 20, "add a"), "malformed": (4, 40, ""), "rule: positive": (1, 10, "")}
    assert s.validation_report(rows.limit(0), "t").where("name = 'all'").first().n == 0


def test_first_of_a_hot_key(spark):
    df = spark.range(5000).selectExpr("if(id % 10 = 0, id % 7, 0) as k", "5000 - id as v")
    by = collections.defaultdict(list)
    for r in df.collect():
        by[r.k].append(r.v)
    assert {r.k: r.few for r in m.listed_first(df, ["k"], "v", 4, "few").collect()} == {k: ",".join(map(str, sorted(v)[:4])) for k, v in by.items()}
    assert "WindowGroupLimit" in m.listed_first(df, ["k"], "v", 4, "few")._jdf.queryExecution().executedPlan().toString()


def test_keywords_by_index(spark):
    texts = ["A Motion to Dismiss; commotion", "motion  to dismiss", "The NDA and agenda", "nothing here", None, "", "chain of custody of the trial exhibit, invoice"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    expected = sorted((i, c, k) for i, t in enumerate(texts) for c, ks in x.KEYWORDS.items() for k in ks if k in (t or "").lower())
    assert sorted((r.id, r.category, r.keyword) for r in x.keyword_hits(df, ["id"]).collect()) == expected
    rows = df.withColumn("category", F.when(F.col("id") == 0, "pleading")).withColumn("confidence", F.when(F.col("id") == 2, 0.9).otherwise(0.5))
    got = [(r.id, r.suggested, r.keywords, r["rank"]) for r in x.other_categories(rows, ["id"]).orderBy("id", "rank").collect()]
    assert got == [(1, "pleading", "motion", 1), (6, "evidence", "exhibit,trial exhibit,chain of custody", 1), (6, "financial", "invoice", 2)]


def test_word_relations(spark):
    rows = [(1, "Smith v. Jones and JONES was an employee of Acme. Acme represents Smith", ["smith", "Jones", "ACME"]), (2, "Smith v. Nobody", ["Smith"]), (3, None, ["a"]), (4, "x v y " * 15, ["x", "y"])]
    got = g.word_relations(spark.createDataFrame(rows, "id long, text string, names array<string>")).collect()
    assert [(r.id, r.source_entity, r.relationship_type, r.target_entity) for r in got][:3] == [(1, "smith", "opposing_party", "Jones"), (1, "Jones", "employment", "ACME"), (1, "ACME", "represents", "smith")]
    assert sum(r.id == 4 for r in got) == 10 and {r.id for r in got} == {1, 4}
