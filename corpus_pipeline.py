"""From raw documents to a mixed training corpus, in five filtering stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that its predecessor kept.  All but the last return the columns of documents, also
where these have further columns of any name; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm.common import cut, documents
from folio.llm.decontamination import without_leaks
from folio.llm.line_dedup import without_repeated_lines
from folio.llm.minhash import without_near_duplicates
from folio.llm.mixing import mix_sources
from folio.llm.toxicity import without_toxic

#: No SQL: MinHash buckets, tiling and the classifier are beyond it; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Each row is judged by its text alone; null and empty texts stay, repeated rows
    get one verdict.  Without labelled rows nothing is rejected.
    """
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that stand earlier (by doc_id).

    Rows are told apart by doc_id and text; null and empty texts stay as they are,
    and no row goes.
    """
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group.

    Each row is a document: a doc_id that is null or stands on several texts joins
    nothing.  The smallest doc_id stays (rows without one come last); of repeated
    rows one stays.  Null and empty texts and those without words all stay.
    """
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text where it is read; null and empty texts hold
    nothing and stay, repeated rows go or stay alike.  Null items match nothing.
    """
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics meet their target weights.

    A draw is a hash of doc_id and text, so repeated rows are drawn alike.  A null
    source or language is a value of its own; a null or empty text is drawn like
    its cell.  The weight is added in a column of its own.
    """
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
