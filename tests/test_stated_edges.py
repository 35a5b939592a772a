"""Stated relationships against a plain search of every pair and template."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folio.operators import graph as g

KINDS = ("PERSON", "ORG", "LOCATION", "DATE", None)


def searched(text, names, least=0.7, around=50, apart=100):
    """Every template over every pair, with the names put in."""
    best, low = {}, text.lower()
    seen = [n for n in names if n[2] and n[2].lower() in low]
    for i, type1, name1 in seen:
        for j, type2, name2 in seen:
            if i == j:
                continue
            for template, kind, base in g.PATTERNS:
                pairs = g.TYPES_OF[kind]
                if not any("ANY" in p for p in pairs) and (type1, type2) not in pairs:
                    continue
                pattern = template.replace("{entity1}", re.escape(name1)).replace("{entity2}", re.escape(name2))
                for m in re.finditer(f"(?isa){pattern}", text):
                    context = text[max(m.start() - around, 0) : m.end() + around].strip().lower()
                    a, z = context.find(name1.lower()), context.find(name2.lower())
                    near = sum(w in context for w in g.BOOSTS.get(kind, ()))
                    score = min(0.95, round(base + 0.05 * near - (0.1 if a >= 0 and z >= 0 and abs(a - z) > apart else 0), 6))
                    if score >= least:
                        best[i, j, kind] = max(best.get((i, j, kind), 0), score)
    return best


def given():
    rnd = random.Random(3)
    names = [("p", "PERSON", "Ann Lee"), ("q", "PERSON", "Bob on"), ("o", "ORG", "Ana Ana"), ("a", "ORG", "a"), ("f", "ORG", "Lee (Firm)"), ("l", "LOCATION", "Ohio"),
             ("d", "DATE", "May 1, 2020"), ("n", None, "Nobody"), ("p", "PERSON", "Lee"), ("e", "ORG", "É\\E"), ("x", "ORG", "")]
    words = ["v.", "versus", "against", "plaintiff", "defendant", "represents", "represented by", "retained", "is an officer of", "works for", "is a unit of", "owns", "based in",
             "company", "entered into a contract with", "Contract between", "and", "paid $5 to", "received x from", "on", "dated", "filed", ",", "\n", " ", "pad " * 30, "İ", "ΑΣ", "Anana ana ANA"]
    rows = []
    for i in range(150):
        some = rnd.sample(names, rnd.randrange(1, 6))
        said = [rnd.choice(words) if rnd.random() < 0.55 else rnd.choice(some)[2] for _ in range(rnd.randrange(2, 9))]
        rows.append((i, " ".join(rnd.choice([x, x, x.upper() if x.isascii() else x]) for x in said), some))
    for template, _, _ in g.PATTERNS:  # each template, in its plainest words
        plain = re.sub(r"\(\?:([^|()]*?)\|[^()]*\)", r"\1", template.replace(r"(?:a\s+)?", "").replace(r"(?:an?\s+)?", "").replace(r"\s+", " ").replace(".*?", " ")).replace("\\", "").replace("?", "")
        for a, z in ((0, 2), (0, 1), (2, 4), (2, 5), (0, 6), (2, 6)):
            rows.append((len(rows), plain.replace("{entity1}", names[a][2]).replace("{entity2}", names[z][2]), [names[a], names[z]]))
    return rows


def test_equals_a_plain_search(spark):
    rows = given()
    chunks = spark.createDataFrame([(i, 0, text) for i, text, _ in rows], "document_id long, chunk_index long, chunk_text string")
    entities = spark.createDataFrame([(i, *n) for i, _, names in rows for n in names], "document_id long, entity_id string, entity_type string, name string")
    got = {(r.document_id, r.source_id, r.target_id, r.relationship_type): r.confidence for r in g.pattern_edges(chunks, entities).collect()}
    expected = {(i, *key): score for i, text, names in rows for key, score in searched(text, names).items()}
    assert got == pytest.approx(expected)
    assert {kind for _, _, _, kind in expected} == {kind for _, kind, _ in g.PATTERNS}


def test_names_beside_the_text_need_no_join(spark):
    """Letters hold their names, so their texts are not shuffled and no pair of rows is joined."""
    from folio.plans.registry import registered

    plan = registered()["edges_pattern"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_context_and_no_names(spark):
    chunks = spark.createDataFrame([(1, 0, "  Ann works for Acme \n")], "document_id long, chunk_index long, chunk_text string")
    names = F.expr("array(named_struct('entity_id', 'p', 'entity_type', 'PERSON', 'name', 'Ann'), named_struct('entity_id', 'o', 'entity_type', 'ORG', 'name', 'ACME'))")
    assert [(r.source_id, r.target_id, r.relationship_type, r.context) for r in g.stated_edges(chunks.withColumn("names", names)).collect()] == [("p", "o", "EMPLOYED_BY", "Ann works for Acme")]
    assert g.stated_edges(chunks.withColumn("names", F.slice(names, 1, 0))).collect() == []
