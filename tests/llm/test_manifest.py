"""The Merkle manifest against a tree built in memory."""

import hashlib
import random
import zlib

import pytest

from tests.llm.test_operators import SCHEMA


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = text.encode().lower().decode()
    return h(*map(told, (doc_id, source, lang, n_chars, text)))


def climb(digests, fan):
    """(root, for each leaf the digests before and after it at each level)."""
    paths, place = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(place):
            run = p // fan * fan
            paths[i].append((digests[run:p], digests[p + 1 : run + fan]))
        place = [p // fan for p in place]
        digests = [h(*digests[i : i + fan]) for i in range(0, len(digests), fan)]
    return digests[0], paths


def brute(rows, fan=16):
    by = {}
    for row in rows:
        by.setdefault(row[3], []).append(row)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in by[s]], fan)
    root, upper = climb([trees[s][0] for s in sources], fan)
    out = []
    for s, above in zip(sources, upper):
        for row, path in zip(by[s], trees[s][1]):
            steps = path + above
            digest = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for before, after in steps:
                digest = h(*before, digest, *after)
            out.append((str(row[0]), leaf(row), trees[s][0], root, h(*[x for b, a in steps for x in b + a]), digest, digest == root))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "h") for r in rows], SCHEMA)


def given(seed, n, sources):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["Plain Text", "lower", "", None, "Ünï É", "A" * 70]) or (None if i % 2 else ""), rnd.choice(["en", None]), rnd.choice(sources), rnd.choice([i, None])) for i in range(n)]
    return rows + [rows[3], rows[3], (7, "another text of row 7", "en", rows[7][3], 5), (None, "No Id", None, None, None), (None, "No Id 2", None, sources[0], None), (-1, "x", "", sources[0], -1)]


@pytest.mark.parametrize(("n", "sources", "fan"), [(700, ["a", "a", "a", "b", None, "é", "", "Z"], 16), (40, ["s"], 16), (90, [f"s{i}" for i in range(40)], 16), (60, ["a", "b"], 2)])
def test_equals_a_tree_in_memory(spark, tmp_path, monkeypatch, n, sources, fan):
    from folio.llm import manifest as m

    rows = given(n, n, sources)
    if fan == 16:
        table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
        got = m.op12_merkle_manifest(spark, str(tmp_path)).collect()
    else:
        *rest, text = [m.F.col(c) for c in m.FIELDS]
        got = m.manifest(table(spark, rows), m.F.when(m.F.crc32(m.F.col("doc_id").cast("string")) % 5 == 0, m.leaf_digest(*rest, m.F.lower(text))), fan).collect()
    assert got[0].asDict().keys() == {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"}
    mine, expected = sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got), brute(rows, fan)
    if fan == 16:
        assert mine == expected and {r[-1] for r in mine} == {True, False}
    else:  # F.lower folds more than A-Z
        assert [r[:5] for r in mine] == [r[:5] for r in expected]


def test_one_row_and_none(spark):
    from folio.llm.manifest import manifest

    row = (5, "Only", "en", "s", 4)
    got = manifest(table(spark, [row])).collect()
    assert [(r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got] == [(leaf(row), leaf(row), leaf(row), h(), leaf(row), True)]
    assert manifest(table(spark, [])).collect() == []


def test_a_tampered_leaf_fails_alone(spark):
    from folio.llm.manifest import F, leaf_digest, manifest

    rows = [(i, f"text {i}", "en", f"s{i % 3}", 6) for i in range(100)]
    swapped = F.when(F.col("doc_id") == 41, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lit("other")))
    assert [r.doc_id for r in manifest(table(spark, rows), swapped).where("not verified").collect()] == [41]


def test_intervals_nest(spark):
    """Each node's interval is the union of its parts', and levels cover all leaves."""
    from folio.llm.manifest import tree
    from folio.operators.ranking import numbered

    rows = numbered(spark.range(300).selectExpr("id % 2 as source", "id", "md5(cast(id as string)) as digest"), ["source"], ["id"], "lo", "total").selectExpr("source", "lo", "lo + 1 as hi", "digest", "total")
    levels = tree(rows, ["source"], 4)
    assert [df.count() for df in levels] == [300, 76, 20, 6, 2]
    for nodes in levels[1:]:
        assert all([p.lo for p in r.parts] == [r.lo] + [p.hi for p in r.parts[:-1]] and r.parts[-1].hi == r.hi and len(r.parts) <= 4 for r in nodes.collect())
        assert {r.source: r["sum((hi - lo))"] for r in nodes.groupBy("source").agg({"hi": "max"}).join(nodes.selectExpr("source as s", "hi - lo as w").groupBy("s").sum("w").withColumnRenamed("sum(w)", "sum((hi - lo))"), nodes["source"] == __import__("pyspark").sql.functions.col("s")).collect()} == {0: 150, 1: 150}
