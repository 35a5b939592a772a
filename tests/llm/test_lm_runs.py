"""The language model's passes over runs of texts, against plain loops."""

import collections
import random

import numpy as np
import pyarrow as pa

from folio.llm import lm_scoring as lm


def _text(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé.") for _ in range(rnd.randrange(1, 6))) for _ in range(n))


def _numbers(taken, parts):
    keys = lm._group_keys(taken)
    order, places = lm._packs(lm.part_of(keys, parts), parts)
    value = (keys[order] % np.uint64(13) + np.uint64(2)).astype(np.float32)
    return keys, pa.table({"part": [q for q, _, _ in places], "numbers": [value[a:b].tobytes() for _, a, b in places]})


def test_costs_of_symbols_in_blocks():
    rnd = random.Random(2)
    table = pa.table({"text": [_text(rnd, 30_000), "", _text(rnd, 3)]})
    taken = lm._take_apart(table, ["text"])
    keys, numbers = _numbers(taken, 5)
    assert np.array_equal(keys, np.unique(np.concatenate([x for t in taken for x in (t.grams, t.words)])))
    known, code = lm.Numbers(taken, numbers, 5), taken[0].code
    assert len(code) > 1 << 16 and np.array_equal(known.of_symbols(code), known.of(code))
    assert known.of_symbols(code[:0]).tolist() == []


def test_earlier_places():
    rnd = np.random.default_rng(4)
    for n, kinds in ((0, 1), (1, 1), (4000, 30), (200_000, 90_000)):
        text = np.sort(rnd.integers(0, 5, n))
        one, two = rnd.integers(0, kinds, n), rnd.integers(0, 3, n)
        for keys in ((one,), (two, one)):
            seen, expected = collections.Counter(), []
            for k in zip(text.tolist(), *(x.tolist() for x in keys)):
                expected.append(seen[k])
                seen[k] += 1
            assert lm._earlier(text, *keys).tolist() == expected


def test_a_group_hands_its_gate_counts_on_once(monkeypatch):
    rnd = random.Random(6)
    monkeypatch.setattr(lm, "CHUNK", 300)
    texts = [_text(rnd, 40) for _ in range(20)] + [""]
    table = pa.table({"doc_id": range(21), "text": texts, "key": range(21), "learning": [i % 3 > 0 for i in range(21)]})
    _, numbers = _numbers(lm._take_apart(table, ["text"]), 4)
    frequent, often = np.array([2**64 - 1], np.uint64), np.array([0])
    found = lm._score(np.array([50.0, 9, 9, 20]), frequent, often, 14, 4)(table, numbers)
    codes = [np.frombuffer(x, np.int32) for x in found["fit_codes"].to_pylist() if x is not None]
    n = [np.frombuffer(x, np.int64) for x in found["fit_n"].to_pylist() if x is not None]
    pieces = sum(len(x.split(" ")) for i, x in enumerate(texts) if i % 3)
    assert len(codes) == len(n) == 1 and len(set(codes[0].tolist())) == len(codes[0]) and n[0].sum() == pieces
    assert sorted(found["doc_id"].to_pylist()) == list(range(21))
