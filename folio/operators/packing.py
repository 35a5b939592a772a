"""Greedy batch packing in a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pack(rows: DataFrame, keys: list[str], order: list[str], size: str = "size_mb", most: int = 100, count: int = 25) -> DataFrame:
    """rows with `batch`: within each key, in order, a batch is closed when the
    next row would take it over `most` in size or it holds `count` rows.

    The rule depends on all rows before, so a key's rows are walked in one task;
    they are sorted by Spark and streamed, not gathered.  A row larger than
    `most` has a batch of its own.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def walk(batches):
        last, batch, filled, n = None, 0, 0, 0
        for pdf in batches:
            numbers = []
            for *key, amount in zip(*[pdf[k] for k in keys], pdf[size]):
                if key != last:
                    last, batch, filled, n = key, 0, 0, 0
                elif filled + amount > most or n >= count:
                    batch, filled, n = batch + 1, 0, 0
                filled, n = filled + amount, n + 1
                numbers.append(batch)
            yield pdf.assign(batch=numbers)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(walk, schema)


def renumbered(packed: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """Rows packed within (keys, priority) with `batch` counted on, from 1, from
    one priority of the keys to the next."""
    n = packed.groupBy(*keys, priority).agg((F.max("batch") + 1).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(priority).rowsBetween(Window.unboundedPreceding, -1)  # a row for each priority
    n = n.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return packed.join(n, [*keys, priority]).withColumn("batch", F.col("batch") + F.col("_before") + 1).select(*packed.columns)
