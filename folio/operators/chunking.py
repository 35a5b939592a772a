"""Cutting documents into chunks, and the quality of the cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_fixed(docs: DataFrame, size: int = 1000, overlap: int = 200, text: str = "text") -> DataFrame:
    """Windows of `size` characters, each starting `overlap` before the last end.

    Chunk k exists if it is the first or the one before it ended inside the text.
    Without overlap a last chunk of one character is left out.  Empty texts have
    no chunks.  Keeps the other columns; no shuffle.
    """
    if not (100 <= size <= 10_000 and 0 <= overlap < size):
        raise ValueError(f"size {size} must be 100 to 10000, overlap {overlap} from 0 to less than that")
    step = size - overlap
    n = F.length(text)
    last = F.ceil(F.greatest(n - size, F.lit(0)) / step)
    if overlap == 0:
        last = F.when((n > size) & (n - last * step == 1), last - 1).otherwise(last)
    rest = [c for c in docs.columns if c != text]
    start = F.col("chunk_index") * step
    return (
        docs.where(n > 0)
        .withColumn("chunk_index", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
        .select(
            *rest,
            "chunk_index",
            F.substring(F.col(text), (start + 1).cast("int"), F.lit(size)).alias("chunk_text"),
            start.alias("char_start"),
            F.least(start + size, n).cast("long").alias("char_end"),
        )
    )


def chunk_neighbours(chunks: DataFrame, document: str = "document_id", index: str = "chunk_index") -> DataFrame:
    """chunks with previous_chunk and next_chunk of their document."""
    order = Window.partitionBy(document).orderBy(index)
    return chunks.withColumns({"previous_chunk": F.lag(index).over(order), "next_chunk": F.lead(index).over(order)})


def ends_mid_sentence(text: Column) -> Column:
    return ~F.rtrim(text).rlike(r"[.!?:;\"')\]]\z")


def chunk_quality(chunks: DataFrame) -> DataFrame:
    """Per document: sizes, coverage, and counts of flawed chunks, with issues."""
    order = Window.partitionBy("document_id").orderBy("chunk_index")
    size = F.length("chunk_text")
    rows = chunks.withColumns({"size": size, "gap": F.lead("char_start").over(order) - F.col("char_end")})
    stats = rows.groupBy("document_id").agg(
        F.count("*").alias("chunk_count"),
        F.sum("size").alias("total_size"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.sum(F.col("size") * F.col("size")).alias("squares"),
        F.max("char_end").alias("text_size"),
        (F.sum("size") / F.count("*")).alias("avg_size"),
        F.count_if(F.length(F.trim("chunk_text")) == 0).alias("empty_chunks"),
        F.count_if(F.col("size") < 50).alias("small_chunks"),
        F.count_if(ends_mid_sentence(F.col("chunk_text"))).alias("mid_sentence"),
        F.count_if(F.col("gap") < 0).alias("overlapping"),
        F.sum(F.greatest(-F.coalesce("gap", F.lit(0)), F.lit(0))).alias("shared"),
    )
    # standard deviation over half the mean, in whole numbers: n*S2 - S^2 > S^2 / 4
    uneven = F.col("chunk_count") * F.col("squares") - F.col("total_size") ** 2 > F.col("total_size") ** 2 / 4
    spread = F.sqrt(F.greatest(F.col("chunk_count") * F.col("squares") - F.col("total_size") * F.col("total_size"), F.lit(0))) / F.col("chunk_count")
    issues = F.array_compact(
        F.array(
            F.when(F.col("empty_chunks") > 0, "empty"),
            F.when(F.col("small_chunks") > 0, "small"),
            F.when(F.col("mid_sentence") > 0, "mid_sentence"),
            F.when(F.col("overlapping") > 0, "overlap"),
            F.when(uneven, "uneven"),
        )
    )
    covered = (F.col("total_size") - F.col("shared")) / F.col("text_size")
    return stats.withColumns({"issues": F.array_join(issues, ","), "std_size": spread, "coverage": covered}).drop("squares", "shared")


def chunk_quality_score(quality: DataFrame) -> DataFrame:
    """1, less the share of small chunks and half the share cut mid-sentence."""
    small = F.col("small_chunks") / F.col("chunk_count")
    cut = F.col("mid_sentence") / F.col("chunk_count")
    return quality.select("document_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (1 - small) * (1 - 0.5 * cut))).alias("score"))
