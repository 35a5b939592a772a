"""Name comparison and naming rules, as columns."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from folio.operators.resolve import SUFFIXES, name_likeness


def is_generic(name: Column, terms: tuple[str, ...], most: int) -> Column:
    return reduce(lambda a, b: a + b, [name.contains(t).cast("int") for t in terms]) > most


#: Document types and words that tell them, in order.
DOC_TYPES = {
    "complaint": ("complaint", "petition", "claim"),
    "answer": ("answer", "response", "reply"),
    "motion": ("motion", "move", "request"),
    "brief": ("brief", "memorandum", "memo"),
    "order": ("order", "ruling", "decision"),
    "notice": ("notice", "notification"),
    "subpoena": ("subpoena", "summons"),
    "deposition": ("deposition", "depo", "testimony"),
    "interrogatory": ("interrogatory", "interrogatories", "questions"),
    "agreement": ("agreement", "contract", "deal"),
    "amendment": ("amendment", "modification", "addendum"),
    "invoice": ("invoice", "bill", "statement"),
    "letter": ("letter", "correspondence", "communication"),
}


def doc_type(text: Column) -> Column:
    """The first type any of whose words the text contains."""
    low = F.lower(text)
    hits = [F.when(reduce(lambda a, b: a | b, [low.contains(p) for p in patterns]), kind) for kind, patterns in DOC_TYPES.items()]
    return F.coalesce(*hits, F.lit("document"))


def naming_issues(files: DataFrame) -> DataFrame:
    """file_id and what is wrong with its name, collisions included."""
    safe, n = F.col("safe"), F.length("safe")
    same = F.count("*").over(Window.partitionBy("safe"))
    marks = {"short": n < 30, "long": n > 60, "character": safe.contains("?"), "extension": ~safe.contains("."), "collision": same > 1}
    return files.select("file_id", F.array_join(F.array_compact(F.array(*[F.when(mark, F.lit(k)) for k, mark in marks.items()])), ",").alias("issues"))


@F.pandas_udf(DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else name_likeness(x, y) for x, y in zip(a, b)], dtype="float64")


def similarity(a: Column, b: Column, ratio: bool = False) -> Column:
    """1 if equal, 0.9 if one contains the other, else the larger of 0.8 of the
    words in common and the edit distance's (with `ratio`: the matching ratio's,
    which takes a Python worker) likeness."""
    if ratio:
        return _likeness(a, b)
    a, b = F.lower(F.trim(a)), F.lower(F.trim(b))
    edit = 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
    words = lambda c: F.array_distinct(F.split(c, r"\s+"))
    shared = 0.8 * F.size(F.array_intersect(words(a), words(b))) / F.greatest(F.size(words(a)), F.size(words(b)))
    return F.when(a == b, 1.0).when(a.contains(b) | b.contains(a), 0.9).otherwise(F.greatest(edit, shared))


def _person(name: Column) -> tuple[Column, Column]:
    """(last name, first initial), of "First Last" or "Last, First"."""
    low = F.lower(F.trim(name))
    comma = low.contains(",")
    words = F.split(low, r"\s+")
    last = F.when(comma, F.trim(F.split(low, ",")[0])).otherwise(F.element_at(words, -1))
    first = F.when(comma, F.trim(F.get(F.split(low, ","), F.lit(1)))).otherwise(words[0])
    return last, F.substring(first, 1, 1)


def person_variation(a: Column, b: Column) -> Column:
    """Same last name and same first initial."""
    (last, first), (last2, first2) = _person(a), _person(b)
    return (last == last2) & (first == first2) & (first != "")


def _org(name: Column) -> Column:
    low = F.regexp_replace(F.lower(name), r"[.,]", "")
    return reduce(lambda text, pair: F.regexp_replace(text, rf"\b{pair[0]}\b", pair[1]), SUFFIXES.items(), low)


def org_variation(a: Column, b: Column) -> Column:
    """Equal once suffixes are shortened and dots dropped, or one the initials
    of the other."""
    x, y = _org(a), _org(b)
    initials = lambda c: F.array_join(F.transform(F.split(c, r"\s+"), lambda w: F.substring(w, 1, 1)), "")
    return (x == y) | (F.replace(x, F.lit(" "), F.lit("")) == initials(y)) | (F.replace(y, F.lit(" "), F.lit("")) == initials(x))


def date_variation(a: Column, b: Column) -> Column:
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    return (digits(a) != "") & (digits(a) == digits(b))
