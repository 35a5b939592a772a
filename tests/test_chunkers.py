"""Queries that SQL can't tell, against loops over the same rows."""

import hashlib
import re

import pyarrow.parquet as pq
import pytest

from folio.plans.registry import registered


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(data):
    t = pq.read_table(f"{data}/documents.parquet").to_pydict()
    return {i: x for i, x in zip(t["doc_id"], t["text"]) if x is not None}


def merged(parts, least):
    out, held = [], ""
    for p in parts:
        held = f"{held}\n\n{p}" if held else p
        if len(held) >= least:
            out.append(held)
            held = ""
    return out + ([held] if held else [])


def test_simple_markdown(spark, data, texts):
    def mark(p):
        if len(p) < 80 and re.search("[A-Z]", p) and p.upper() == p:
            return f"## {p}"
        return f"### {p}" if len(p) < 80 and re.match(r"\d+\.", p) else p

    expected = {i: md5("\n\n".join(map(mark, re.split(r"\n[ \t\n\r\f\v]*\n", x.replace("\n", "\n\n"))))) for i, x in texts.items()}
    assert {r.doc_id: r.digest for r in registered()["simple_markdown"](spark, data).collect()} == expected


def test_chunk_markdown(spark, data, texts):
    expected = set()
    for i, x in texts.items():
        at = n = 0
        for s in re.split(r"\n(?=#)|\n\s*\n", x.replace("\n", "\n\n# "), flags=re.ASCII):
            s = re.sub(r"^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$", "", re.sub(r"^#{1,6}\s+", "", s, flags=re.ASCII))
            if not s:
                continue
            found = x.find(s, at)
            if found >= 0:
                expected.add((i, n, found, found + len(s), md5(s)))
                at, n = found + len(s), n + 1
    assert {tuple(r) for r in registered()["chunk_markdown"](spark, data).select("doc_id", "chunk_index", "char_start", "char_end", "digest").collect()} == expected and expected


def test_chunk_merge_small(spark, data):
    t = pq.read_table(f"{data}/conversations.parquet").to_pydict()
    turns = {}
    for c, n, x in sorted(zip(t["conv_id"], t["turn"], t["text"])):
        turns.setdefault(c, []).append(x)
    expected = {(c, n, len(p), md5(p)) for c, parts in turns.items() for n, p in enumerate(merged(parts, 400))}
    assert {tuple(r) for r in registered()["chunk_merge_small"](spark, data).select("document_id", "chunk_index", "size", "digest").collect()} == expected


def test_chunk_fallback(spark, data, texts):
    expected = set()
    for i, x in texts.items():
        lines = x.split("\n")
        if len(lines) >= 3:
            expected |= {(i, "sections", n, md5(p)) for n, p in enumerate(merged(lines, 300))}
        elif x:
            windows = range(0, 800 * (1 + -(-max(len(x) - 1000, 0) // 800)), 800)
            expected |= {(i, "fixed", n, md5(x[a : a + 1000])) for n, a in enumerate(windows)}
    got = {tuple(r) for r in registered()["chunk_fallback"](spark, data).select("doc_id", "method", "chunk_index", "digest").collect()}
    assert got == expected and {m for _, m, *_ in got} == {"sections", "fixed"}
