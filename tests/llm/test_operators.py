"""Training-data operators against brute force, on small and awkward tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, band int, hub string"


def make(spark, rows):
    return spark.createDataFrame([(i, x, "en", f"s{(i or 0) % 3}", len(x or ""), 1, "h") for i, x in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, null, empty and long texts."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = prose(80), prose(30)
    out = [(0, base), (1, base), (2, None), (3, ""), (4, "one two"), (5, "one two"), (6, "   \n\t ")]
    for i in range(7, 27):
        changed = base.split()
        for _ in range(rnd.randrange(1, 6)):
            changed[rnd.randrange(len(changed))] = rnd.choice(words)
        out.append((i, " ".join(changed)))
    out += [(i, f"{prose(20)} {passage} {prose(15)}") for i in range(27, 45)]
    out += [(i, "\n".join(rnd.choice(["alpha beta", "gamma", "delta x", "  ", "eps", "zeta eta"]) for _ in range(25))) for i in range(45, 60)]
    out += [(60, prose(6000)), (61, "Ünï çodé " * 40), (70, "x" * 70000), (5000, prose(12))]
    return out


def words_of(text, fold=False):
    data = (text or "").encode()
    return (data.lower() if fold else data).split()


def sets_of(rows):
    out = {}
    for i, x in rows:
        w = words_of(x, True)
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def test_minhash_components(spark, rows):
    from folio.llm.minhash import near_duplicates

    sets = sets_of(rows)
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for z in sets:
            if a < z and sets[a] and sets[z]:
                both = len(sets[a] & sets[z])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[z]) - both):
                    x, y = find(a), find(z)
                    root[max(x, y)] = min(x, y)
    got = {r.doc_id: r for r in near_duplicates(make(spark, rows + [rows[0], (None, "no id")])).collect()}
    assert set(got) == set(sets)
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i)


def test_tiles_find_links_that_hubs_miss():
    import pyarrow as pa

    from folio.llm.minhash import _apart

    base = np.arange(100)
    members = [base, np.concatenate([base[:85], 1000 + np.arange(15)]), np.concatenate([base[:84], 1000 + np.arange(15)])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 1]), pa.array([0, 0, 0], pa.int32()), pa.array([0, 0, 0], pa.int32()), pa.array([0, 0, 0], pa.int32()), pa.array([3, 5, 9]),
         pa.array([3, 5, 9]), pa.array([m.astype(np.int64) for m in members], pa.list_(pa.int64()))],
        names=["band", "a", "b", "mine", "doc_id", "component", "shingles"])
    links = {tuple(x) for out in _apart(75)([batch]) for x in zip(*[c.to_pylist() for c in out.columns])}
    assert (5, 9) in links


def test_minhash_of_large_buckets(spark, rows, monkeypatch):
    """Buckets of several tiles, thinned out by rare shingles, give the same result."""
    from folio.llm import minhash as m

    rnd = random.Random(12)
    template = [f"t{i}" for i in range(60)]
    given = []
    for i in range(120):  # a template with own words: some alike, most not; and chains of near copies
        own = [rnd.choice("abcdefghij") + str(rnd.randrange(10**6)) for _ in range(rnd.choice([4, 9, 14, 30]))]
        given.append((i, " ".join(template + own)))
    base = template + [f"z{i}" for i in range(40)]
    for i in range(200, 230):
        base = base[:-3] + [f"y{i}_{j}" for j in range(3)]
        given.append((i, " ".join(base)))
    expected = {r.doc_id: r.component_id for r in m.near_duplicates(make(spark, given)).collect()}
    monkeypatch.setattr(m, "TILE_DOCUMENTS", 2)
    got = {r.doc_id: r.component_id for r in m.near_duplicates(make(spark, given)).collect()}
    sets = sets_of(given)
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    pairs = set()
    for a in sets:
        for z in sets:
            both = len(sets[a] & sets[z])
            if a < z and 100 * both >= 75 * (len(sets[a]) + len(sets[z]) - both):
                pairs.add((a, z))
                x, y = find(a), find(z)
                root[max(x, y)] = min(x, y)
    assert got == expected == {i: find(i) for i in sets}
    members = spark.createDataFrame([(i, i) for i in sets], "doc_id long, component long")
    table = make(spark, given).select("doc_id", "text").mapInArrow(m._sets, "doc_id long, shingles array<long>")
    meeting = {r.doc_id for r in m._meeting(members, table, 75).collect()}
    assert {i for p in pairs for i in p} <= meeting and len(meeting) < len(sets)


def brute_windows(rows, size=13):
    """By (id, text): words, words removed and hash of what is kept."""
    first = {}
    for i, x in rows:
        w = words_of(x)
        for j in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[j : j + size])
            first[key] = min(first.get(key, 1 << 60), i)
    out = {}
    for i, x in rows:
        w = words_of(x)
        keep = [True] * len(w)
        for j in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[j : j + size])] < i:
                keep[j : j + size] = [False] * size
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out[i, x] = (len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def awkward(rows):
    """Ids on two texts, repeated rows and rows without an id."""
    passage = " ".join(f"p{i}" for i in range(40))
    other = " ".join(f"q{i}" for i in range(40))
    lines = "\n".join(f"line {i} of the passage" for i in range(6))
    more = [(2, other), (2, f"{passage}\n{lines}"), (1, passage), (1, lines), (2, "\n".join(f"own {i}" for i in range(6))), (None, passage), (None, lines), (-5, passage)]
    return rows + more + [rows[0], rows[30]]


def test_substring_dedup(spark, rows, awkward):
    from folio.llm.substring_dedup import remove_repeated_substrings

    for given in (rows, awkward):
        expected = brute_windows(given)
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_substrings(make(spark, given)).collect()]
        assert sorted(got, key=repr) == sorted(((i, *expected[i, x]) for i, x in given), key=repr)
    assert remove_repeated_substrings(make(spark, rows).limit(0)).count() == 0


def test_substring_dedup_of_hot_passages_in_parts(spark, rows):
    from folio.llm import substring_dedup as s

    docs = make(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("key"))
    gone = collections.defaultdict(set)
    for r in s.removed_spans(docs, per_shard=3).collect():
        gone[r.doc_id] |= set(range(r.start, r.stop))
    expected = brute_windows(rows)
    assert all(len(gone[i]) == expected[i, x][1] for i, x in rows)


def brute_lines(rows, order, long_line=12):
    """By (id, text): lines deleted and text kept; order: of rows by (id, text)."""
    first, parts = {}, {}
    for i, x in sorted({r for r in rows if r[0] is not None}, key=order):
        lines = (x or "").split("\n")
        solid = [(j, line.strip(" \t\r\x0b\x0c")) for j, line in enumerate(lines) if line.strip(" \t\r\x0b\x0c")]
        runs = [(k, 3) for k in range(len(solid) - 2)] + [(k, 1) for k, (_, v) in enumerate(solid) if len(v.split()) >= long_line]
        parts[i, x] = lines, solid, runs
        for k, n in sorted(runs):
            first.setdefault(tuple(v for _, v in solid[k : k + n]), (order((i, x)), k))
    out = {}
    for (i, x), (lines, solid, runs) in parts.items():
        drop = {j for k, n in runs if first[tuple(v for _, v in solid[k : k + n])] < (order((i, x)), k) for j, _ in solid[k : k + n]}
        out[i, x] = len(drop), "\n".join(v for j, v in enumerate(lines) if j not in drop) if drop else x
    return out | {(i, x): (0, x) for i, x in rows if i is None}


def test_line_dedup(spark, rows, awkward):
    from folio.llm.line_dedup import dedup_lines, without_repeated_lines

    boiler = "this one long line of twelve or more words stands in several texts"
    given = awkward + [(80, boiler), (81, f"x\n  {boiler}\t\ny"), (82, f"{' ' * 30_000}a\n{boiler}")]
    key = {r.text: r.key for r in make(spark, given).select("text", F.xxhash64("text").alias("key")).collect()}
    expected = brute_lines(given, lambda r: (r[0], key[r[1]]))
    got = sorted(((r.doc_id, r.n_removed, r.kept_text) for r in dedup_lines(make(spark, given)).collect()), key=repr)
    assert got == sorted(((i, *expected[i, x]) for i, x in given), key=repr)
    assert expected[81, f"x\n  {boiler}\t\ny"][0] == 1
    assert dedup_lines(make(spark, rows).limit(0)).count() == 0
    named = make(spark, given).withColumns({"_id": F.lit(1), "_starts": F.lit("s"), "_key": F.lit(2), "start": F.lit(3)})
    kept = without_repeated_lines(named)
    assert kept.columns == named.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((i, t) for i, _, t in got), key=repr)


def test_tiling_finds_reordered_passages(spark):
    from folio.llm.decontamination import leaks

    item = " ".join(f"q{i}" for i in range(30))
    parts = item.split()
    moved = " ".join(parts[20:] + ["mid"] + parts[:10] + ["dle"] + parts[10:20])
    docs = make(spark, [(1, f"Before. {item.upper()} after"), (2, f"x y {moved} z"), (3, " ".join(parts[:9])), (4, None), (5, ""), (6, "clean " * 50)])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "a b"), (7, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.tiled_words, r.coverage) for r in leaks(docs, bench).collect()}
    assert got == {(1, 7): (30, 1.0), (2, 7): (30, 1.0)}
    assert leaks(docs, bench.limit(0)).count() == 0 and leaks(docs.limit(0), bench).count() == 0


def brute_tiles(doc, item, size):
    """Greedy string tiling, straight from its definition."""
    taken_doc, taken_item, tiles = set(), set(), []
    while True:
        best, matches = size - 1, []
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in taken_doc and i + n not in taken_item:
                    n += 1
                if n > best:
                    best, matches = n, []
                if n == best and n >= size:
                    matches.append((d, i))
        if not matches:
            return tiles
        for d, i in matches:
            if not (set(range(d, d + best)) & taken_doc or set(range(i, i + best)) & taken_item):
                tiles.append((d, i, best))
                taken_doc |= set(range(d, d + best))
                taken_item |= set(range(i, i + best))


def test_tiling_against_its_definition(spark):
    from folio.llm.decontamination import leaks, tile

    rnd = random.Random(9)
    for _ in range(60):
        doc = [rnd.randrange(3) for _ in range(rnd.randrange(0, 40))]
        item = [rnd.randrange(3) for _ in range(rnd.randrange(1, 25))]
        got = tile(np.array(doc, np.uint64), np.arange(len(doc)), np.array(item, np.uint64), 3)
        assert sorted(got) == sorted(brute_tiles(doc, item, 3))
    words = "abc"
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(40)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 20)))) for i in range(15)]
    expected = {}
    for d, x in docs:
        for i, y in items:
            n = sum(t[2] for t in brute_tiles(x.split(), y.split(), 4)) if len(y.split()) >= 4 else 0
            if n and n >= 0.5 * len(y.split()):
                expected[d, i] = n
    found = leaks(make(spark, docs), spark.createDataFrame(items, "item_id long, text string"), size=4, block_chars=100)
    assert {(r.doc_id, r.item_id): r.tiled_words for r in found.collect()} == expected


def test_tiling_of_a_long_repetitive_text():
    import tracemalloc

    from folio.llm.decontamination import _search

    import pyarrow as pa

    search = _search([1], [" ".join(["la"] * 300)], 5, 0.5)
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([" ".join(["la"] * 20_000)])], names=["doc_id", "text"])
    tracemalloc.start()
    (out,) = list(search([batch]))
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()
    assert out.to_pylist()[0]["tiled_words"] == 300


def test_toxicity(spark):
    from folio.llm import toxicity as t

    rnd = random.Random(1)
    words = [f"wo{i}rd" for i in range(200)]
    docs, labels = [], []
    for i in range(400):
        w = [rnd.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                w[rnd.randrange(40)] = rnd.choice(["vilething", "nastyword"])
        if i % 7 == 0:
            w[3] = "women"
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    table = make(spark, docs + [(1000, None), (1001, "")])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = t.train(table.select("doc_id", "text"), marks, t.held_out_rows)
    got = {r.doc_id: r._toxicity for r in t.score_toxicity(table, model).collect()}
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in range(400))
    mention = spark.createDataFrame([(1, docs[1][1]), (2, docs[1][1] + " women")], "doc_id long, text string")
    a, b = (r._toxicity for r in t.score_toxicity(mention, model).orderBy("doc_id").collect())
    assert abs(a - b) < 0.05 and 0 <= got[1000] == got[1001] < 0.7
    assert t.train(table.select("doc_id", "text"), marks.limit(0), t.held_out_rows).gain == 0.0
    named = table.withColumns({"_toxicity": F.lit("mine"), "toxic": F.lit(1), "slot": F.lit(2)})
    kept = t.without_toxic(named, marks)
    assert kept.columns == named.columns and {r._toxicity for r in kept.collect()} == {"mine"}
    assert t.without_toxic(table.limit(0), marks).count() == 0


def test_toxicity_counterfactuals(spark):
    """Naming a group, or another one, moves no score of a neutral text far."""
    from folio.llm import toxicity as t

    rnd = random.Random(8)
    words = [f"wo{i}rd" for i in range(150)]
    docs, labels = [], []
    for i in range(600):
        w = [rnd.choice(words) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            w[5:9] = ["nastyword", rnd.choice(["muslims", "women", "refugees"]), "vilething", "nastyword"]
        elif i % 9 == 0:
            w[7] = rnd.choice(["muslims", "women", "refugees"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    table = make(spark, docs).select("doc_id", "text")
    model = t.train(table, spark.createDataFrame(labels, "doc_id long, toxic int"), t.held_out_rows)
    neutral = [x for i, x in docs if i % 4 and i % 9][:100]
    pairs = [(i, x) for i, x in enumerate(neutral)] + [(1000 + i, x + " muslims") for i, x in enumerate(neutral)] + [(2000 + i, x + " atheists") for i, x in enumerate(neutral)]
    got = {r.doc_id: r._toxicity for r in t.score_toxicity(spark.createDataFrame(pairs, "doc_id long, text string"), model).collect()}
    assert all(got[1000 + i] < 0.7 and abs(got[1000 + i] - got[2000 + i]) < 0.2 for i in range(len(neutral)))
    held = t.score_toxicity(table, model).where(t.held_out_rows(F.col("doc_id"))).collect()
    assert np.mean([(r._toxicity >= 0.7) == (r.doc_id % 4 == 0) for r in held]) > 0.95


def test_fingerprints(spark, rows):
    from folio.llm.fingerprints import fingerprint_documents

    got = {r.doc_id: r for r in fingerprint_documents(make(spark, rows)).collect()}
    ordered = sorted((i, x or "") for i, x in rows)
    for at, (i, x) in enumerate(ordered):
        nxt = ordered[(at + 1) % len(ordered)][1]
        q = len(x) // 4
        edited = x[: len(x) - q] + nxt[:q]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    assert fingerprint_documents(make(spark, rows).limit(0)).count() == 0


def test_fingerprints_against_brute_force(spark, rows):
    """Signatures as tuples of words; likeness as their Jaccard."""
    import regex

    from folio.llm import fingerprints as f

    given = rows + [(100, "12"), (101, "zebra"), (102, "???"), (103, "zebra"), (104, "日本 語の 文 です ね また 今日"), (None, "12"), (-3, "The cat sat on the mat, and the dog.")]
    ordered = sorted(((i, x or "") for i, x in given), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    edits = [x[: len(x) - len(x) // 4] + ordered[(at + 1) % len(ordered)][1][: len(x) // 4] for at, (_, x) in enumerate(ordered)]
    spoken = sorted({w for x in [x for _, x in given] + edits for w in regex.findall(r"[\p{L}\p{N}]+", (x or "").lower())})
    table = spark.createDataFrame([(w,) for w in spoken], "w string").selectExpr("w", "pmod(hash(w), 16) = 0 as rare")
    rare = {r.w for r in table.collect() if r.rare}

    def spots(text):
        words = ["^", *regex.findall(r"[\p{L}\p{N}]+", text.lower())]
        out = set()
        for i, w in enumerate(words):
            if w in f.ANCHORS or w == "^" or w in rare:
                chain = [v for v in words[i + 1 : i + 1 + f.REACH] if v not in f.ANCHORS][: f.CHAIN]
                out |= {(w, *chain)} if len(chain) == f.CHAIN else set()
        return out or ({text} if text else set())

    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = collections.defaultdict(list)
    for r in f.fingerprint_documents(make(spark, given)).collect():
        got[r.doc_id].append(r)
    for at, (i, x) in enumerate(ordered):
        nxt = ordered[(at + 1) % len(ordered)][1]
        edited = edits[at]
        (row,) = got[i]
        assert row.n_signatures == len(spots(x)) and len(row.fingerprint) == 8 * len(spots(x)), i
        assert math.isclose(row.near_edited, jaccard(spots(x), spots(edited))) and math.isclose(row.near_next, jaccard(spots(x), spots(nxt))), i
    assert got[100][0].fingerprint != got[101][0].fingerprint != got[102][0].fingerprint and got[101][0].fingerprint == got[103][0].fingerprint


def test_next_keys(spark):
    from folio.llm.fingerprints import next_keys

    keys = [0, 1, 5, 999, 1000, 4_000_000, 4_000_001, 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    got = dict(next_keys(df, max(keys), 10).collect())
    assert got == dict(zip(keys, keys[1:] + [None]))


def test_spotsigs_pairs(spark):
    from folio.llm.fingerprints import near_pairs

    rnd = random.Random(2)
    sets = {i: sorted(rnd.sample(range(60), rnd.randrange(5, 40))) for i in range(40)}
    sets[40], sets[41] = sets[3], []
    df = spark.createDataFrame(list(sets.items()), "doc_id long, sigs array<int>")
    got = {(r.a, r.b) for r in near_pairs(df, 0.5).collect()}
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    assert got == {(a, b) for a in range(40) for b in range(a + 1, 40) if sets[a] != sets[b] and jaccard(sets[a], sets[b]) >= 0.5}


def test_licenses(spark):
    from folio.llm.licenses import scan_licenses

    docs = make(spark, [(1, "Licensed under CC BY-NC 4.0.\nAll rights\nreserved. All rights reserved"), (2, None), (3, "x"), (3, "Released under the MIT License."),
                        (None, "the GNU General Public License here"), (5, "über cc  by")])
    got = {(r.doc_id, r.n_words): r for r in scan_licenses(docs).collect()}
    wrapped = make(spark, [(7, "Permission is hereby granted, free of charge,\nto any person obtaining a copy\nof this software"), (8, "word " * 500 + "Released under\nthe MIT license " + "word " * 300),
                           (9, " ".join(f"{w} {'filler ' * 30}" for w in "released under the mit license".split()))])
    assert {r.doc_id: r.labels for r in scan_licenses(wrapped).collect()} == {7: "mit-grant", 8: "mit", 9: ""}
    assert scan_licenses(wrapped.limit(0)).count() == 0
    one = got[(1, 13)]
    assert (one.n_base, one.first_word, one.last_word, one.base_labels) == (3, 2, 10, "cc-by,reserved")
    assert got[(2, 0)].first_word is None and got[(2, 0)].labels == "" and got[(3, 1)].labels == ""
    assert got[(3, 5)].labels == "mit" and got[(None, 6)].base_labels == "gpl" and got[(5, 3)].n_base == 1


def test_urls(spark):
    from folio.llm.url_filter import judge_urls

    urls = ["HTTP://WWW.Example.COM/en/7?x#y", "http://a.net/de/8", "http://example.net/de/85", "http://x.org/es/", "nothing", None, "http://b.com", "ftp://u.com/en/a/b#c"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df).collect()}
    assert got[0] == ("www.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[1][2:] == ("net/de/", "allow") and got[2][2:] == ("example.net/de/8", "block") and got[3][2:] == ("org/es/", "block")
    assert got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None) and got[6][:3] == ("b.com", "", None)
    assert got[7] == ("u.com", "/en/a/b", "com/en/", "block")
    assert judge_urls(df.limit(0)).count() == 0


def test_url_model_against_brute_force(spark):
    """Counts, smoothing, ratios, threshold and verdicts, worked out in loops."""
    from folio.llm import url_filter as u

    rnd = random.Random(7)
    name = lambda n: "".join(rnd.choice("abcdef") for _ in range(n))
    urls = [f"http://{name(3)}.net/de/{name(4)}" for _ in range(40)] + [f"http://{name(3)}.com/en/{name(4)}" for _ in range(40)]
    urls += [f"http://{name(4)}.io/{rnd.choice(['de', 'en'])}/{name(3)}" for _ in range(30)] + ["", urls[0]]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in u.judge_urls(df).collect()}
    apart = {r.url: r.apart for r in df.selectExpr("url", "pmod(xxhash64(url), 5) = 0 as apart").collect()}
    judged = {x: got[i].verdict if got[i].rule else None for i, x in enumerate(urls)}
    count = {"allow": collections.Counter(), "block": collections.Counter()}
    pad = lambda x: u.START * u.ORDER + x.lower() + u.END
    grams = lambda x: [pad(x)[i : i + u.ORDER + 1] for i in range(len(x) + 1)]
    seen = set()
    for x in set(urls):
        seen |= set(grams(x))
        if judged[x] and not apart[x]:
            for g in grams(x):
                for k in range(u.ORDER + 1):
                    count[judged[x]][g[-k - 1 :]] += 1

    def chance(g, kind):
        p = 1 / u.ALPHABET
        for k in range(u.ORDER + 1):
            own, context = count[kind][g[-k - 1 :]], sum(n for h, n in count[kind].items() if len(h) == k + 1 and h[:k] == g[-k - 1 : -1])
            p = (own + u.PSEUDO_COUNT * p) / (context + u.PSEUDO_COUNT)
        return p

    ratio = {g: math.log(chance(g, "allow")) - math.log(chance(g, "block")) for g in seen}
    score = {x: sum(ratio[g] for g in grams(x)) / len(grams(x)) for x in set(urls)}
    assert all(math.isclose(got[i].score, score[x], abs_tol=1e-9) for i, x in enumerate(urls))
    good, bad = (sorted(score[x] for x in set(urls) if apart[x] and judged[x] == v) for v in ("allow", "block"))
    threshold = (good[math.ceil(0.05 * len(good)) - 1] + bad[math.ceil(0.95 * len(bad)) - 1]) / 2
    assert all(got[i].verdict == (judged[x] or ("allow" if score[x] >= threshold else "block")) for i, x in enumerate(urls))


def test_mixing(spark, rows):
    from folio.llm import mixing as m

    docs = make(spark, [(i, "word " * (5 + i % 11)) for i in range(600)] + [(601, None)])
    targets = {"source": {"s0": 0.6, "s1": 0.3, "s2": 0.1}, "lang": {"en": 1.0}}
    got = m.chances(docs, dimensions=("source", "lang"), targets=targets, keep=0.4).drop("row").toPandas()
    mass = (got["tokens"] * got["weight"]).groupby(got["source"]).sum()
    assert np.allclose(mass / mass.sum(), [0.6, 0.3, 0.1], atol=1e-3)
    assert abs((got["tokens"] * got["probability"]).sum() / got["tokens"].sum() - 0.4) < 0.01
    assert m.mix_sources(docs).columns == [*docs.columns, "mix_weight"]
    assert m.mix_sources(docs.limit(0)).count() == 0
    named = docs.withColumn("mix_weight", F.lit(9)).withColumn("tokens", F.lit(3)).withColumn("weight", F.lit(1)).withColumn("row", F.lit(2))
    kept = m.mix_sources(named)
    assert kept.columns == [*named.columns, "mix_weight_"] and {r.tokens for r in kept.collect()} == {3}


def test_raking_against_brute_force(spark):
    """Three marginals, in plain loops; and targets that contradict each other."""
    from folio.llm import mixing as m

    rnd = random.Random(4)
    cells = [(s, g, t, rnd.randrange(1, 1000)) for s in "abc" for g in "xy" for t in "pq" if rnd.random() < 0.9]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.7, "q": 0.3}}
    got = {(r.source, r.lang, r.topic): r for r in m.rake(df, targets=targets).collect()}
    weight = {c[:3]: 1.0 for c in cells}
    for _ in range(200):
        for at, dim in enumerate(("source", "lang", "topic")):
            for value, share in targets[dim].items():
                mine = [c for c in cells if c[at] == value]
                total = sum(c[3] * weight[c[:3]] for c in mine)
                for c in mine:
                    weight[c[:3]] *= share / total
    assert all(math.isclose(got[k].weight, w, rel_tol=2e-3) and got[k].miss < 1e-3 for k, w in weight.items())
    tied = spark.createDataFrame([("a", "x", 10), ("b", "y", 10)], "source string, lang string, tokens long")
    with pytest.raises(ValueError, match="can't be met"):
        m.rake(tied, ("source", "lang"), {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.5, "y": 0.5}})


def test_topics_against_brute_force(spark):
    from folio.llm import mixing as m

    rnd = random.Random(6)
    kinds = [[f"content{i}" for i in range(a, a + 25)] + ["a", "bc", "Of"] for a in (0, 40, 80)]
    docs = make(spark, [(i, " ".join(rnd.choice(kinds[i % 3]) for _ in range(rnd.randrange(0, 60)))) for i in range(90)] + [(91, None), (92, " \n ")])
    got = {r.row.doc_id: r for r in m.chances(docs).collect()}
    words = {w.lower() for ws in kinds for w in ws}
    kind = {r.w: r.k for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "pmod(hash(w), 32) as k").collect()}
    count = {i: np.array([sum(kind[w.lower()] == k for w in (got[i].row.text or "").split() if len(w) >= 5) for k in range(32)], float) for i in got}
    corpus = sum(count.values()) + 1
    corpus = corpus / corpus.sum()
    topics = np.array([np.where(np.arange(32) % 8 == k, 4 * corpus, corpus) for k in range(8)])
    topics /= topics.sum(axis=1, keepdims=True)
    likeliest = lambda n: int(np.argmax(np.round(np.log(topics) @ n, 9)))
    for _ in range(6):
        by = {k: [n for n in count.values() if n.sum() and likeliest(n) == k] for k in range(8)}
        topics = np.array([(sum(by[k]) + 1000 * corpus) / (np.sum(by[k]) + 1000) if by[k] else topics[k] for k in range(8)])
    for i, n in count.items():
        assert got[i].tokens == len((got[i].row.text or "").split())
        assert got[i].topic == (f"topic{likeliest(n)}" if n.sum() else "none")


def test_topics_tell_vocabularies_apart(spark):
    """Texts of different words get different topics, whatever their source."""
    from folio.llm import mixing as m

    rnd = random.Random(7)
    kinds = [[f"{stem}{rnd.randrange(10**6)}" for _ in range(12)] for stem in ("alphas", "betas", "gammas")]
    docs = make(spark, [(i, " ".join(rnd.choice(kinds[i % 3]) for _ in range(200))) for i in range(240)])
    by = collections.defaultdict(collections.Counter)
    for r in m.chances(docs).collect():
        by[r.row.doc_id % 3][r.topic] += 1
    assert all(c.most_common(1)[0][1] >= 76 for c in by.values()) and len({c.most_common(1)[0][0] for c in by.values()}) == 3


def test_lm_scores(spark, rows, monkeypatch):
    from folio.llm import lm_scoring as lm

    given = rows + [rows[0], (8, "another text of that id"), (None, "no id")]
    count = collections.Counter()
    for i, x in given:
        if zlib.crc32(str(i).encode()) % 7 != 2 or i is None:
            count.update(words_of(x, True) + [None])
    total = sum(count.values())
    expected = []
    for i, x in given:
        tokens = words_of(x, True) + [None]
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens)
        expected.append((i, len((x or "").encode()), len(tokens), sum(count[w] > 0 for w in tokens), total, f"{base:.9g}"))
    for frequent in (lm.FREQUENT_WORDS, 3):  # how many words travel with the tasks changes nothing
        monkeypatch.setattr(lm, "FREQUENT_WORDS", frequent)
        found = lm.score_texts(make(spark, given)).collect()
        got = [(r.doc_id, r.n_bytes, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.9g}") for r in found]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        score = {(r.doc_id, r.n_bytes): r.score for r in found}
        assert all(r.score < 0 for r in found) and score[2, 0] == score[3, 0] and len({r.score for r in found if r.doc_id in (0, 1)}) == 1
    assert lm.score_texts(make(spark, rows).limit(0)).count() == 0


def test_lm_score_against_brute_force(spark):
    """The whole score, from counts to bits, in plain loops over the model's parameters."""
    from folio.llm import lm_scoring as lm

    rnd = random.Random(11)
    words = ["the", "cat", "sat.", "dog", "ran", "far", "Über", "mat"]
    given = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 25))) + rnd.choice(["", "\n", " x"])) for i in range(40)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    learning = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in given}
    got = {r.doc_id: r for r in lm.score_texts(df).collect()}
    model = lm.train(lm.tallied(df.withColumn("learning", ~lm.held_out_rows(F.col("doc_id"))))[0])
    tape = {i: [0] * 5 + list(x.encode()) + [lm.END] for i, x in given}
    follow = collections.Counter()
    for i, t in tape.items():
        for at in range(5, len(t)) if learning[i] else ():
            for order in lm.ORDERS:
                for j in range(9):
                    follow[order, tuple(t[at - order : at]), j, t[at] >> (8 - j)] += 1

    def cost(t, at):
        bits = 0.0
        for j in range(8):
            bit, odds = (t[at] >> (7 - j)) & 1, []
            for order in lm.ORDERS:
                context = tuple(t[at - order : at])
                one, zero = (follow[order, context, j + 1, ((t[at] >> (8 - j)) << 1) | b] for b in (1, 0))
                odds.append(math.log((one + lm.PRIOR) / (zero + lm.PRIOR)))
            gate = sum(o != 0 for o in odds) * 8 + j
            x = sum(o * w for o, w in zip(odds + [0.3], model.weights[gate].tolist()))
            place = (min(max(x, -7.999), 7.999) + 8) * (lm.BUCKETS - 1) / 16
            low = int(place)
            fine = model.refine[gate]
            x = 0.5 * x + 0.5 * (fine[low] * (1 - place + low) + fine[low + 1] * (place - low))
            bits += math.log2(1 + math.exp(-x if bit else x))
        return bits

    def pieces(t):
        """(bytes, what stood before, cost) of each piece."""
        out, begin = [], 5
        for at in range(5, len(t)):
            if t[at] in (0x20, 9, 10, 11, 12, 13, lm.END):
                before, second = t[begin - 1], t[begin - 2]
                stood = 3 if before == 0 else 2 if before == 10 else 1 if second in (46, 33, 63) else 0
                out.append((bytes(t[begin : at + 1]), stood, sum(cost(t, k) for k in range(begin, at + 1))))
                begin = at + 1
        return out

    taken = {i: pieces(t) for i, t in tape.items()}
    known, totals = collections.Counter(), collections.Counter()
    for i, ps in taken.items():
        for piece, stood, _ in ps if learning[i] else ():
            known[piece, stood] += 1
            totals[stood] += 1

    def experts(ps, without):
        seen, pairs, followed, before = collections.Counter(), collections.Counter(), collections.Counter(), None
        for n, (piece, stood, bits) in enumerate(ps):
            chance = [
                max(known[piece, stood] - without, 0) / max(totals[stood] - without, 1),
                seen[piece] / max(n, 1),
                pairs[before, piece] / max(followed[before], 1),
            ]
            gate = min(int(math.log2(n + 1)), 9) * 4 + min(followed[before], 3)
            odds = [1.0]
            for c in chance:
                step = min(max(math.floor((math.log2(c) + bits) * lm.FINENESS + 1e-9) + lm.STEPS // 2, 0), lm.STEPS - 1) if c else 0
                odds.append(2 ** ((step - lm.STEPS // 2) / lm.FINENESS) if step else 0.0)
            yield gate, odds, bits
            seen[piece] += 1
            followed[before] += 1
            pairs[before, piece] += 1
            before = piece

    mix = np.full((lm.WORD_GATES, 4), 0.25)
    fit = [e for i, ps in taken.items() if learning[i] for e in experts(ps, 1)]
    for _ in range(25):
        mass = np.full((lm.WORD_GATES, 4), 0.5)
        for gate, odds, _b in fit:
            part = mix[gate] * odds
            mass[gate] += part / part.sum()
        mix = mass / mass.sum(axis=1, keepdims=True)
    for i, ps in taken.items():
        bits = sum(b - math.log2(float(mix[g] @ np.array(o))) for g, o, b in experts(ps, 0))
        assert math.isclose(got[i].score, -bits * math.log10(2), rel_tol=0.02, abs_tol=0.05), i


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data).cache()
        assert set(columns) <= set(docs.columns) and 0 < docs.count() <= seen, name
        seen = docs.count()
    assert docs.select(F.max("doc_id")).first()[0] is not None


def test_lm_counts_grow_with_the_corpus(spark):
    """Costs and word counts come from exact tables, however many contexts there are."""
    from folio.llm import lm_scoring as lm

    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rnd.choice(letters) for _ in range(10)) for _ in range(12_000)]
    docs = [(i, " ".join(words[i::8] * 2), True) for i in range(8)] + [(8, "xyzzy quux", False)]
    df = spark.createDataFrame(docs, "doc_id long, text string, learning boolean")
    table, parts = lm.tallied(df)
    model = lm.train(table)
    numbers = lm.looked_up(model, table, parts, df.withColumn("grouped", F.lit(1).cast("long")))
    known = lm.Numbers(lm._take_apart(df.toArrow(), ["text"]), numbers.toArrow(), parts)
    found = lm.words_in(table, lm.GRAM).toArrow()
    grams, n = found.column("word").to_numpy(), found.column("n").to_numpy()
    counts = lm.Counts(grams[n > 0].astype(np.uint64), n[n > 0])
    order5 = collections.Counter()
    for g, m in zip(grams.tolist(), n.tolist()):
        order5[g >> 8] += m
    some = grams[:5000].astype(np.uint64)
    ones, zeros, _ = counts.of(some)(0, len(some))
    assert (ones + zeros)[:, 0, 4].tolist() == [order5[g >> 8] for g in some.tolist()] and len(order5) > 80_000
    assert np.allclose(known.of(some), lm.bit_costs(model.weights, model.refine, counts, some), atol=1e-4)
    cost = np.array([known.of(lm.symbols(np.frombuffer(w.encode(), np.uint8), np.array([0, 10]))[0])[5:10].sum() for w in words[:200]])
    assert cost.mean() < 5  # five bytes that are certain after the five before
    pieces = lm.pieces_of(lm.symbols(np.frombuffer(docs[0][1].encode(), np.uint8), np.array([0, len(docs[0][1])]))[0])
    assert known.of(pieces.key | lm.WORD)[1:-1].tolist() == [2.0 - (w in (docs[0][1].split()[0], docs[0][1].split()[-1])) for w in docs[0][1].split()[1:-1]]
