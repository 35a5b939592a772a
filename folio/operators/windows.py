"""Order-dependent operators: latest rows, best rows, gaps, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.ranking import numbered


def _descending(columns: list[str]) -> list[Column]:
    return [F.desc(c) for c in columns]


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; aggregated before the shuffle, not sorted."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return last.select(*keys, "_row.*").select(*df.columns)


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key in that order, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def stage_gaps(tasks: DataFrame) -> DataFrame:
    """Seconds between successive completed stages of a document."""
    order = Window.partitionBy("document_id").orderBy("ts", "event_id")
    done = tasks.where("status = 'completed'")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(order).cast("timestamp"))
    return done.select("document_id", "event_id", "stage", F.lag("stage").over(order).alias("previous_stage"), gap.alias("gap_us"))


def position_context(chunks: DataFrame) -> DataFrame:
    """Where in its document a chunk stands: beginning, early, middle, late, end."""
    own = Window.partitionBy("document_id")
    at = F.row_number().over(own.orderBy("chunk_index")) - 1
    n = F.count("*").over(own)
    rows = chunks.select("document_id", "chunk_index", at.alias("at"), n.alias("n"))
    share = F.col("at") / F.col("n")
    word = F.when(F.col("at") == 0, "beginning").when(F.col("at") == F.col("n") - 1, "end").when(share < 0.2, "early").when(share > 0.8, "late").otherwise("middle")
    return rows.select("document_id", "chunk_index", word.alias("position"))


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("running", F.sum(value).over(upto))


def islands(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """df with `island`: rows of a key whose [start, end) ranges overlap share one."""
    before = Window.partitionBy(*keys).orderBy(start, F.desc(end)).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(start, F.desc(end)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.when(F.col(start) >= F.coalesce(F.max(end).over(before), F.col(start)), 1).otherwise(0)
    return df.withColumn("_fresh", fresh).withColumn("island", F.sum("_fresh").over(upto)).drop("_fresh")


def fixed_batches(df: DataFrame, keys: list[str], order: list, size: int) -> DataFrame:
    """df with `batch`: runs of `size` rows of each key in that order, from 0."""
    return numbered(df, keys, order, "_at").withColumn("batch", F.floor(F.col("_at") / size).cast("long")).drop("_at")


def trailing_count(df: DataFrame, key: str, seconds: int, ts: str = "ts") -> DataFrame:
    """df with `recent`: rows of the key in the trailing window, itself included."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    window = Window.partitionBy(key).orderBy(at).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("recent", F.count("*").over(window))
