"""The pipeline's stages on rows with null, shared and repeated ids, and very long URLs."""

import collections
import random
import time

import numpy as np
import pytest

from tests.llm.test_operators import SCHEMA, sets_of, words_of


def table(spark, rows):
    return spark.createDataFrame([(i, x, lang, "s", len(x or ""), k, "h") for k, (i, x, lang) in enumerate(rows)], SCHEMA)


def shown(df):
    return collections.Counter((r.doc_id, r.text, r.lang) for r in df.collect())


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(500)}" for _ in range(n))


@pytest.mark.parametrize("block_chars", [8_000_000, 60])
def test_leaks_go_by_row(spark, block_chars):
    """Rows without id, ids on several texts and repeated rows, in one block and in several."""
    from folio.llm.decontamination import without_leaks

    item, other = prose(1, 20), prose(2, 15)
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, "")], "item_id long, text string")
    leak, clean = f"{prose(3, 20)} {item} {prose(4, 9)}", prose(5, 60)
    rows = [(1, leak, "a"), (1, clean, "b"), (None, leak, "c"), (None, clean, "d"), (3, clean, "e"), (3, clean, "e"), (4, other.upper(), "f"), (4, None, "g"), (5, "", "h"), (5, leak, "i"), (5, leak, "i")]
    docs = table(spark, rows).withColumnRenamed("hub", "item_id")
    got = without_leaks(docs, bench, block_chars=block_chars)
    assert got.columns == docs.columns
    assert shown(got) == collections.Counter(r for r in rows if r[1] not in (leak, other.upper()))
    assert without_leaks(docs.limit(0), bench).count() == 0 and shown(without_leaks(docs, bench.limit(0))) == collections.Counter(rows)


def test_near_duplicates_go_by_row(spark):
    from folio.llm.minhash import without_near_duplicates

    base, far = prose(7, 80), prose(8, 80)
    near = base + " end"
    rows = [(2, base, "a"), (3, near, "b"), (3, far, "c"), (None, base, "d"), (None, prose(9, 50), "e"), (None, prose(9, 50), "e"), (6, prose(10, 30), "f"), (6, prose(10, 30), "f"),
            (7, None, "g"), (7, None, "g"), (8, "", "h"), (9, " \n", "i"), (2, prose(11, 40), "j"), (10, "one two", "k"), (11, "One Two", "l")]
    docs = table(spark, rows).withColumnRenamed("hub", "node")
    got = without_near_duplicates(docs)
    assert got.columns == docs.columns
    gone = collections.Counter([(3, near, "b"), (None, base, "d"), (None, prose(9, 50), "e"), (6, prose(10, 30), "f"), (11, "One Two", "l")])
    assert shown(got) == collections.Counter(rows) - gone
    assert without_near_duplicates(docs.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    """What each stage takes away, told from the words of the rows that reach it."""
    import corpus_pipeline as cp
    from folio.llm.decontamination import TILE

    item, base, passage = prose(20, 18), prose(21, 90), "\n".join(prose(30 + i, 6) for i in range(5))
    rows = [(i, prose(100 + i, 60) + "\n" + prose(200 + i, 50), "en") for i in range(30)]
    rows += [(40, base, "en"), (41, base + " tail", "en"), (None, base, "en"), (41, prose(300, 40), "en"), (42, f"{prose(301, 20)} {item} {prose(302, 20)}", "en"),
             (None, f"{item}", "en"), (42, prose(303, 45), "en"), (43, f"{prose(304, 30)}\n{passage}\n{prose(305, 30)}", "en"), (44, f"{prose(306, 30)}\n{passage}\n{prose(307, 30)}", "en"), (45, None, "en")]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stages["toxicity"](spark, docs, str(tmp_path))
    assert shown(kept) == collections.Counter(rows)  # nothing is known to be toxic
    lines = stages["line_dedup"](spark, kept, str(tmp_path)).cache()
    expected = collections.Counter((i, x.replace(f"\n{passage}", "") if i == 44 else x, lang) for i, x, lang in rows)
    assert shown(lines) - expected == expected - shown(lines) or {i for i, *_ in (shown(lines) - expected)} <= {None, 41}  # a whole text may be a line that stands earlier
    sets = {}
    for r in lines.collect():
        sets.setdefault((r.doc_id, r.text), set()).update(sets_of([(0, r.text)])[0])
    near = stages["near_duplicates"](spark, lines, str(tmp_path)).cache()
    left = shown(near)
    texts = list(left)
    alike = [(a, z) for k, a in enumerate(texts) for z in texts[:k] if sets[a[:2]] and 100 * len(sets[a[:2]] & sets[z[:2]]) >= 75 * len(sets[a[:2]] | sets[z[:2]])]
    assert not alike and not left - shown(lines)
    for gone in shown(lines) - left:
        assert any(100 * len(sets[gone[:2]] & sets[z[:2]]) >= 75 * len(sets[gone[:2]] | sets[z[:2]]) for z in texts if sets[z[:2]])
    clean = shown(stages["decontamination"](spark, near, str(tmp_path)))
    own = words_of(item, True)

    def covered(x):
        w, mine = words_of(x, True), [False] * len(own)
        for a in range(len(own) - TILE + 1):
            if any(w[b : b + TILE] == own[a : a + TILE] for b in range(len(w))):
                mine[a : a + TILE] = [True] * TILE
        return 2 * sum(mine) >= len(own)

    assert clean == collections.Counter({k: n for k, n in left.items() if not covered(k[1])}) and sum(clean.values()) < sum(left.values())


def test_a_very_long_url_takes_no_longer_than_its_length(spark):
    from folio.llm.url_filter import judge_urls

    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    urls = [f"http://{word(4)}.{rnd.choice(['net/de/', 'com/en/'])}{word(6)}" for _ in range(60)] + [None, "", None]
    tables = [spark.createDataFrame(list(enumerate([*urls, "http://a.io/" + word(n)])), "page_id long, url string") for n in (10, 200_000, 800_000)]
    judge_urls(tables[0]).collect()
    took = [9e9] * 3  # the best of two: other work on the machine counts for less
    for _ in range(2):
        for k, df in enumerate(tables):
            began = time.time()
            rows = judge_urls(df).collect()
            took[k] = min(took[k], time.time() - began)
            assert len(rows) == len(urls) + 1 and all(r.score is not None for r in rows)
    short, long = took[1] - took[0], took[2] - took[0]
    assert long < 8 * max(short, 1.0)  # four times the length; by its square it would be sixteen times


@pytest.mark.parametrize("full", [1, 40, 300])
def test_full_automata_make_way(spark, monkeypatch, full):
    """Whatever an automaton may hold, the same words go."""
    from folio.llm import substring_dedup as sd
    from tests.llm.test_operators import brute_windows

    rnd = random.Random(3)
    shared = [prose(400 + i, 25) for i in range(4)]
    rows = [(i, f"{prose(500 + i, rnd.randrange(30))} {rnd.choice(shared)} {prose(600 + i, rnd.randrange(40))} {rnd.choice(shared)}") for i in range(40)]
    rows += [(50, prose(700, 900)), (51, prose(700, 900)), (52, " ".join(prose(700, 900).split()[300:500])), (None, shared[0]), (53, None), (53, shared[1])]
    monkeypatch.setattr(sd, "AUTOMATON_WORDS", full)
    reference = sd._Reference(13)
    expected = set()
    for i, x in rows:
        words = np.array([hash(w) & (1 << 63) - 1 for w in (x or "").split()], np.uint64)
        seen = reference.seen(words)
        own = [tuple(words[j : j + 13].tolist()) for j in range(max(len(words) - 12, 0))]
        assert [w in expected for w in own] == seen.tolist()
        for a, b in sd._runs(~seen):
            reference.add(words[a : b + 12])
        expected |= set(own)
    if full == 1:  # and through the whole operator
        gone = brute_windows(rows)
        got = sd.remove_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert collections.Counter((r.doc_id, r.n_removed) for r in got) == collections.Counter((i, gone[i, x][1]) for i, x in rows)
