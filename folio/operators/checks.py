"""Whether what the stages made of a document fits together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least completeness and most minutes of a sound run.
LEAST_CONSISTENCY, MOST_MINUTES = 85, 30


def consistency(sources: DataFrame, chunks: DataFrame, mentions: DataFrame, resolved: DataFrame) -> DataFrame:
    """Per source document: completeness (half for stages that have rows, half for
    the checks between stages that could be made), whether all checks hold, issues.

    sources has doc_id and text, chunks document_id, chunk_index and chunk_text,
    mentions document_id, chunk_index and mention, resolved document_id and
    mention.  Chunk texts must be within a tenth of the text's length, mentions
    stand in chunks that exist, resolved ones be mentions that exist.
    """
    places = chunks.select("document_id", "chunk_index").distinct().withColumn("here", F.lit(True))
    placed = mentions.groupBy("document_id", "chunk_index").agg(F.lit(1).alias("one")).join(places, ["document_id", "chunk_index"], "left")
    placed = placed.groupBy("document_id").agg(F.count_if(F.col("here").isNull()).alias("misplaced"))
    one = mentions.select("document_id", "mention").distinct().withColumn("here", F.lit(True))
    known = resolved.select("document_id", "mention").distinct().join(one, ["document_id", "mention"], "left")
    known = known.groupBy("document_id").agg(F.count_if(F.col("here").isNull()).alias("unknown"))
    sizes = chunks.groupBy("document_id").agg(F.sum(F.length("chunk_text")).alias("chunk_size"))
    rows = sources.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    for part in (sizes, placed, known):
        rows = rows.join(part.withColumnRenamed("document_id", "doc_id"), "doc_id", "left")
    stages = {"source_document": F.col("size") > 0, "chunks": F.col("chunk_size").isNotNull(), "entities": F.col("misplaced").isNotNull(), "resolution": F.col("unknown").isNotNull()}
    near = F.abs(F.col("size") - F.col("chunk_size")) * 10 < F.col("size")
    checks = {
        "source_to_chunks": F.when(stages["source_document"] & stages["chunks"], near),
        "chunks_to_entities": F.when(stages["chunks"] & stages["entities"], F.col("misplaced") == 0),
        "entities_to_resolution": F.when(stages["entities"] & stages["resolution"], F.col("unknown") == 0),
    }
    total = lambda marks: reduce(lambda a, z: a + z, [m.cast("int") for m in marks])
    made = total([c.isNotNull() for c in checks.values()])
    held = total([F.coalesce(c, F.lit(False)) for c in checks.values()])
    completeness = 12.5 * total(stages.values()) + F.when(made > 0, 50.0 * held / F.greatest(made, F.lit(1))).otherwise(0.0)
    issues = [F.when(~mark, "no " + k) for k, mark in stages.items()] + [F.when(~mark, k) for k, mark in checks.items()]
    return rows.select("doc_id", completeness.alias("completeness"), ((made > 0) & (made == held)).alias("consistent"), F.array_compact(F.array(*issues)).alias("issues"))


def validate_flow(consistent: DataFrame, runs: DataFrame, least: float = LEAST_CONSISTENCY, most: float = MOST_MINUTES) -> DataFrame:
    """Per document whether its run passed from end to end, with its issues.

    consistent is what `consistency` gives; runs has doc_id, stage, status and minutes.
    """
    rows = consistent.select("doc_id", "completeness").join(runs, "doc_id", "left")
    status = F.coalesce("status", F.lit("unknown"))
    issues = F.array_compact(F.array(
        F.when(status != "completed", F.concat(F.lit("not completed: "), status)), F.when(status == "failed", F.concat(F.lit("failed stages: "), "stage")),
        F.when(F.col("completeness") < least, "low consistency"), F.when(F.coalesce("minutes", F.lit(0)) > most, "took too long")))
    return rows.select("doc_id", (F.size(issues) == 0).alias("passed"), issues.alias("issues"))


def coverage_score(entities: Column, pages: Column, size: Column, types: Column) -> Column:
    """50, and up to 20 for two entities a page, 20 for three types and 10 for five
    entities in 1,000 characters; at most 100."""
    share = lambda part: F.least(F.lit(1.0), part)
    dense = F.when(size > 0, share(entities * 1000.0 / size / 5) * 10).otherwise(0.0)
    return F.round(F.least(F.lit(100.0), 50 + share(entities / pages / 2) * 20 + share(types / 3) * 20 + dense), 6)
