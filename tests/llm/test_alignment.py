"""Token alignment against loops over tokens and bytes."""

import collections
import hashlib
import os

import pytest

from folio.llm.alignment import BYTE_BPE, PIECE_BPE
from tests.llm.test_operators import make

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_BPE), reason="no tokenizers here")


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    done = []
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled = ([bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]])
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            done.append(([], [], [], []))
            continue
        ends = []
        for s in spelled:
            at, own = 0, []
            for x in s:
                own.append((at, at + len(x)))
                at += len(x)
            ends.append(own)
        linked, j = [], 0
        for i, (low, high) in enumerate(ends[0]):
            while ends[1][j][1] <= low:
                j += 1
            k = j
            while k < len(ends[1]) and ends[1][k][0] < high:
                linked.append((ids[0][i], ids[1][k]))
                k += 1
        cuts = sorted({z for _, z in ends[0]} & {z for _, z in ends[1]})
        groups, at = [], [0, 0]
        for z in cuts:
            sides = []
            for s in (0, 1):
                own = at[s]
                while ends[s][at[s]][1] < z:
                    at[s] += 1
                at[s] += 1
                sides.append(",".join(map(str, ids[s][own : at[s]])))
            groups.append("|".join(sides))
        done.append((ids[0], ids[1], groups, linked))
    counts = collections.Counter(x for *_, linked in done for x in linked)
    highest = collections.Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for ids_a, ids_b, groups, linked in done:
        told = hashlib.sha256(";".join(groups).encode()).hexdigest() if linked else ""
        out.append((len(ids_a), len(ids_b), len(groups), len(linked), sum(counts[x] == highest[x[1]] for x in linked), sum(counts[x] for x in linked), told))
    return out


def given():
    rows = [None, "", " ", "a", "The quick brown fox", "the  quick\n\n brown\tfox  ", "Ünïcödé façade – “quotes”", "汉字 and かな 한글 ᚠᛇᚻ", "🙂🙂 emoji‍", "<|endoftext|> <s> </s> <unk>", "a▁b", "<0x41>", "x" * 3000,
            "née", "ﬁne ①", "don't can't WE'RE", "1234567 3.14", "word " * 4000, "\x00\x01", "The quick brown fox"]
    return list(enumerate(rows)) + [(3, "the quick brown fox jumps"), (None, "no id here")]


@pytest.mark.parametrize("frequent", [1 << 17, 40, 0])
def test_equals_brute_force(spark, frequent):
    from folio.llm.alignment import align

    rows = given()
    got = align(make(spark, rows), frequent=frequent).collect()
    assert got[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    mine = collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got)
    expected = brute([x for _, x in rows])
    by = collections.Counter((i, *r) for (i, _), r in zip(rows, expected))
    assert mine == by and any(r[0] and r[2] < min(r[:2]) for r in expected)


def test_small_parts_give_the_same(spark, monkeypatch):
    """Blocks of one text each, counts told often."""
    from folio.llm import alignment as al

    rows = given()
    whole = sorted(map(str, al.align(make(spark, rows)).collect()))
    monkeypatch.setattr(al, "ALIGN_BYTES", 1)
    monkeypatch.setattr(al, "COUNT_BYTES", 1)
    assert sorted(map(str, al.align(make(spark, rows)).collect())) == whole


def test_both_libraries_encode_alike(data):
    """Merging by rank gives what the vocabulary's own library gives."""
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from folio.llm.alignment import byte_level

    with open(BYTE_BPE, encoding="utf-8") as f:
        encode, _ = byte_level(f.read())
    whole = Tokenizer.from_file(BYTE_BPE)
    whole.encode_special_tokens = True
    texts = [" " + x for x in pq.read_table(f"{data}/documents.parquet").column("text").to_pylist() if x] + [" " + x for _, x in given() if x]
    assert encode(texts) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_pieces_word_by_word(data, monkeypatch):
    """Encoding word by word gives what the model gives for whole texts, also when little is remembered."""
    import pyarrow.parquet as pq
    import sentencepiece

    from folio.llm import alignment as al

    monkeypatch.setattr(al, "REMEMBERED", 10)
    with open(PIECE_BPE, "rb") as f:
        encode, _ = al.piece_level(f.read())
    texts = [x for x in pq.read_table(f"{data}/documents.parquet").column("text").to_pylist() if x] + [x for _, x in given() if x] + ["end ", "end  ", "  two", " ", "   "]
    whole = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE).encode(texts)
    assert [encode([x])[0] for x in texts] == whole == encode(texts)


def test_empty_table(spark):
    from folio.llm.alignment import align

    assert align(make(spark, [])).collect() == []
