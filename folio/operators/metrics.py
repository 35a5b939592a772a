"""Aggregates over processing events, batches, entities and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.ranking import numbered


def rate(part: Column, whole: Column) -> Column:
    """part / whole in percent, 0 where there is nothing."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def counts_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def status_percentages(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows and their share in percent, by status."""
    n = df.groupBy(status).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def stage_metrics(tasks: DataFrame, *keys: str) -> DataFrame:
    """Per stage (and key): runs, time in all and on average, success rate."""
    done, failed = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    return tasks.groupBy(*keys, "stage").agg(
        F.count("*").alias("runs"),
        F.sum("cents").alias("total_cents"),
        (F.sum("cents") / F.count("*")).alias("avg_cents"),
        rate(done, done + failed).alias("success_rate"),
    )


def hourly_rollup(tasks: DataFrame) -> DataFrame:
    """Date, hour, project and stage: processed, failed, average and p95 time,
    and how often each error message came up, as name=count pairs."""
    keys = [F.to_date("ts").alias("day"), F.hour("ts").cast("long").alias("hour"), "project_id", "stage"]
    main = tasks.groupBy(*keys).agg(
        F.count_if(F.col("status") == "completed").alias("processed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        (F.sum("cents") / F.count("*")).alias("avg_cents"),
        F.round(F.percentile("cents", F.lit(0.95)), 2).alias("p95_cents"),
    )
    errors = tasks.where("message is not null").groupBy(*keys, "message").agg(F.count("*").alias("n"))
    pairs = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "message", "n"))), "; ")
    errors = errors.groupBy("day", "hour", "project_id", "stage").agg(pairs.alias("errors"))
    return main.join(errors, ["day", "hour", "project_id", "stage"], "left")


def grouped_summary(df: DataFrame, *dimensions: str, measures: list[Column]) -> DataFrame:
    """One pass over several groupings and the grand total: `dimension`, `value`."""
    sets = [[d] for d in dimensions] + [[]]
    rows = df.groupingSets(sets, *dimensions).agg(*measures, F.grouping_id().alias("_level"))
    bits = len(dimensions)
    name = F.lit("total")
    for i, d in enumerate(dimensions):
        name = F.when(F.col("_level") == (1 << bits) - 1 - (1 << (bits - 1 - i)), d).otherwise(name)
    return rows.withColumns({"dimension": name, "value": F.coalesce(*[F.col(d).cast("string") for d in dimensions])}).drop("_level", *dimensions)


def nearest_rank(df: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """The value at index floor(n * share) of each group's sorted values."""
    ranked = numbered(df.select(*by, value), by, [value], "_at", "_n")
    return ranked.where(F.col("_at") == F.least(F.floor(F.col("_n") * share), F.col("_n") - 1)).select(*by, F.col(value).alias("ranked_value"))


def shannon_entropy(df: DataFrame, by: list[str], category: str) -> DataFrame:
    """Entropy in bits of the category's shares within each group."""
    n = df.groupBy(*by, category).agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(*by))
    parts = n.withColumn("part", -p * F.log2(p))
    return parts.groupBy(*by).agg(F.count("*").alias("types"), F.round(F.sum("part"), 6).alias("entropy"))


def type_distribution(mentions: DataFrame, by: list[str], kind: str = "entity_type") -> DataFrame:
    """Mentions by type within each group: count, percent and whether it is rare."""
    n = mentions.groupBy(*by, kind).agg(F.count("*").alias("n"))
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*by))
    return n.withColumn("percent", share).withColumn("rare", F.col("percent") < 2)


def top_k(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k most frequent key values; ties by the keys."""
    return counts_by(df, *keys).orderBy(F.desc("n"), *keys).limit(k)


def confidence_distribution(df: DataFrame, column: str) -> DataFrame:
    """Histogram by tens with average and bounds; zero scores are left out."""
    rows = df.where(F.col(column) > 0).withColumn("bucket", (F.floor(F.col(column) / 10) * 10).cast("long"))
    level = F.when(F.col("bucket") < 70, "low").when(F.col("bucket") < 90, "medium").otherwise("high")
    return (
        rows.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            (F.sum(column) / F.count("*")).alias("average"),
            F.median(column).alias("median"),
            F.min(column).cast("long").alias("low"),
            F.max(column).cast("long").alias("high"),
        )
        .withColumn("level", level)
    )


def within_hours(df: DataFrame, hours: int, as_of: Column | None = None, ts: str = "ts") -> DataFrame:
    """Rows of the last hours before as_of; by default before the latest row."""
    if as_of is not None:
        return df.where((F.col(ts) > as_of - F.expr(f"INTERVAL {hours} HOURS")) & (F.col(ts) <= as_of))
    latest = df.agg(F.max(ts).alias("_as_of"))
    start = F.col("_as_of") - F.expr(f"INTERVAL {hours} HOURS")
    return df.join(F.broadcast(latest), F.col(ts) > start).drop("_as_of")  # one row


def listed_first(df: DataFrame, keys: list[str], value: str, k: int, name: str, separator: str = ",") -> DataFrame:
    """keys and `name`, the k smallest values of each key in order, joined.

    Ranks over k are cut off before the shuffle and after it, so what meets for a
    key is bounded, however many rows it has.
    """
    order = Window.partitionBy(*keys).orderBy(value)
    few = df.select(*keys, value).withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k)
    return few.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", F.col(value).cast("string").alias("v")))), lambda x: x["v"]), separator).alias(name))
