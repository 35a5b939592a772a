"""Places of rows in a global or per-key order, without a window over a whole key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.sources.storage import written


def numbered(rows: DataFrame, keys: list[str], order: list, rank: str = "rank", total: str | None = None) -> DataFrame:
    """rows with `rank`, each row's place (from 0) among those of its keys in
    `order`, and with `total`, their number.

    Rows are dealt out by ranges of (keys, order), so a key that holds most rows
    lies in many tasks.  A row's place in its range is added to the number of
    its key's rows in the ranges before, of which there are a row for each range
    and key.  Nulls come first; rows equal in keys and order are numbered in any
    order and lie in one range.
    """
    placed = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    found = placed.groupBy(part.alias("_part"), *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = found.select(*[F.col(k).alias(f"_{k}") for k in keys], "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("_total"))
    met = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys), part == F.col("_part"))
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(written(found, "offsets"), met).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(rank), *extra)
