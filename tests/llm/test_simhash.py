"""SimHash groups against brute force, and the Golay buckets against their promise."""

import random

import numpy as np
import xxhash

from tests.llm.test_operators import make, words_of


def brute_print(text):
    w = words_of(text, True)
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    """{row: smallest id reachable} of (id, fingerprint) rows, over all pairs."""
    label = list(range(len(prints)))
    for i, (_, x) in enumerate(prints):
        for j in range(i):
            if bin(x ^ prints[j][1]).count("1") <= 2 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if k == old else k for k in label]
    ids = {}
    for k, (i, _) in zip(label, prints):
        if i is not None:
            ids[k] = min(i, ids.get(k, i))
    return [ids.get(k) for k in label]


def rows():
    rnd = random.Random(8)
    words = [f"Wörd{i}" for i in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, long = prose(60), prose(400)
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "One"), (4, "one"), (5, "One two"), (6, "one\x0btwo "), (7, "one two three"), (9, long), (9, base), (9, base), (None, base), (None, "no id at all")]
    for i in range(20, 60):
        changed = long.split()
        for _ in range(rnd.randrange(1, 5)):
            changed[rnd.randrange(len(changed))] = rnd.choice(words)
        out.append((i, " ".join(changed)))
    out += [(i, prose(rnd.randrange(3, 40))) for i in range(60, 80)]
    return out + [(80, base.upper() + " x"), (81, "a b " * 60000)]


def test_groups_equal_brute_force(spark, monkeypatch):
    from folio.llm import simhash as s

    given = rows()
    prints = [(i, brute_print(x)) for i, x in given]
    expected = sorted((str(i), f"{p:016x}", str(c)) for (i, p), c in zip(prints, groups(prints)))
    for bucket in (s.BUCKET, 1):  # pair by pair, and by shared neighbours only
        monkeypatch.setattr(s, "BUCKET", bucket)
        got = s.fingerprint_groups(make(spark, given)).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert len({c for *_, c in expected}) < len({p for _, p, _ in expected})  # some are linked across bits


def test_links_of_planted_fingerprints(spark, monkeypatch):
    """Chains, clusters and signs; small buckets, large ones and both."""
    from folio.llm import simhash as s
    from folio.llm.components import components

    rnd = random.Random(4)
    prints = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(30):
            prints.add(x)
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 2, 2, 3])))
    center = rnd.getrandbits(64)
    prints |= {center ^ (1 << b) for b in range(64)}
    prints = sorted(prints)
    expected = dict(zip(prints, groups(list(enumerate(prints)))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "print long")
    for bucket in (1, 4, 1000):
        monkeypatch.setattr(s, "BUCKET", bucket)
        found = s.links(df).collect()
        assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in found)
        labels = {r.node: r.component for r in components(s.links(df)).collect()}
        by = {}
        for x in prints:
            by.setdefault(labels.get(signed(x), signed(x)), set()).add(expected[x])
        assert all(len(v) == 1 for v in by.values()) and len(by) == len(set(expected.values()))


def test_golay_indices_meet():
    """Windows at distance two or less share an index: all pairs of errors."""
    from folio.llm.simhash import bucket_keys, golay_indices

    rnd = np.random.default_rng(1)
    windows = rnd.integers(0, 1 << 23, 300)
    own = golay_indices(windows)
    assert set((own >= 0).sum(axis=1)) == {1, 6}
    for a in range(23):
        for b in range(a, 23):
            other = golay_indices(windows ^ (1 << a) ^ ((1 << b) if b > a else 0))
            met = (own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)
            assert met.any(axis=(1, 2)).all()
    x = rnd.integers(0, 1 << 63, 50).astype(np.uint64)
    row, key = bucket_keys(x)
    for a in range(64):
        for b in range(a, 64):
            y = x ^ np.uint64(1 << a) ^ np.uint64((1 << b) if b > a else 0)
            r2, k2 = bucket_keys(y)
            assert set(np.unique(row[np.isin(key * 64 + row, k2 * 64 + r2)])) == set(range(50))


def test_empty_table(spark):
    from folio.llm.simhash import fingerprint_groups

    assert fingerprint_groups(make(spark, [])).collect() == []
