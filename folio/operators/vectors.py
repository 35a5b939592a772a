"""Vector operators: a stated set of queries against all rows, centroids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources.storage import written

#: Projects that are held against the vectors in one pass.
BLOCK = 4096
#: Rows and queries of a tile, about; pivots of the inverted file, at most.
TILE_ROWS, TILE_QUERIES, PIVOTS = 8192, 16384, 64


def _unit(vectors) -> np.ndarray:
    """The vectors of a column in rows of length 1; no rows, no columns."""
    rows = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1 if len(vectors) else 0)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _tiled(rows: DataFrame, queries: DataFrame, most: int | None = None) -> DataFrame:
    """(query_id, vec_id, label, similarity) of rows(cell, vec_id, label, embedding)
    and queries(cell, query_id, vector, bar) in the same cell: similarity at least
    the query's bar, and with `most` just a tile's best for each query (ties stay).

    Rows and queries of a cell are dealt out by hash, so that a tile of the two
    has about TILE_ROWS and TILE_QUERIES of them, however many the cell holds; a
    tile is one matrix product in one task.
    """
    both = rows.select("cell", F.lit(1).alias("r"), F.lit(0).alias("q")).union(queries.select("cell", F.lit(0), F.lit(1)))
    n = both.groupBy("cell").agg(F.sum("r").alias("n_rows"), F.sum("q").alias("n_queries")).where("n_rows > 0 and n_queries > 0")
    plan = written(n.select("cell", F.ceil(F.col("n_rows") / TILE_ROWS).cast("int").alias("across"), F.ceil(F.col("n_queries") / TILE_QUERIES).cast("int").alias("down")), "vector-tiles")
    part = lambda key, parts: F.pmod(F.xxhash64(key), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = rows.join(plan, "cell").withColumn("i", part("vec_id", "across")).withColumn("j", every("down")).select("cell", "i", "j", "vec_id", "label", "embedding")
    right = queries.join(plan, "cell").withColumn("j", part("query_id", "down")).withColumn("i", every("across")).select(F.col("cell").alias("place"), "i", "j", "query_id", "vector", "bar")

    def work(own, asked):
        if not len(own) or not len(asked):
            return pd.DataFrame(columns=["query_id", "vec_id", "label", "similarity"])
        vectors, ids = _unit(own["embedding"]), own["vec_id"].to_numpy()
        out = []
        for start in range(0, len(asked), 512):
            some = asked.iloc[start : start + 512]
            s = vectors @ _unit(some["vector"]).T
            keep = (s >= some["bar"].to_numpy()[None, :]) & (ids[:, None] != some["query_id"].to_numpy()[None, :])
            if most is not None and len(ids) > most:
                bar = np.partition(np.where(keep, s, -2), len(ids) - most, axis=0)[len(ids) - most]
                keep &= s >= bar[None, :] - 1e-9
            i, j = np.nonzero(keep)
            out.append(pd.DataFrame({"query_id": some["query_id"].to_numpy()[j], "vec_id": ids[i], "label": own["label"].to_numpy()[i], "similarity": s[i, j]}))
        return pd.concat(out)

    return left.groupBy("cell", "i", "j").cogroup(right.groupBy("place", "i", "j")).applyInPandas(work, "query_id long, vec_id long, label int, similarity double")


def _placed(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """vectors with `cell`, the pivot nearest to each, and `angle` to it; the pivots.

    The pivots are PIVOTS vectors at most, those of the smallest hashes: any would
    give the same result, others just other work.
    """
    some = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).toPandas()
    pivots = _unit(some["embedding"])

    def work(batches):
        for pdf in batches:
            s = _unit(pdf["embedding"]) @ pivots.T if len(pdf) else np.zeros((0, max(len(pivots), 1)))
            yield pdf.assign(cell=s.argmax(axis=1), angle=np.arccos(np.clip(s.max(axis=1), -1, 1)) if len(pdf) else [])

    columns = vectors.select("vec_id", "label", "embedding")
    return written(columns.mapInPandas(work, T.StructType([*columns.schema.fields, T.StructField("cell", T.LongType()), T.StructField("angle", T.DoubleType())])), "vector-cells"), pivots


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k most similar vectors of each query, exactly, with their rank (ties by
    vec_id, after rounding to nine digits).

    An inverted file: vectors are in the cells of their nearest pivots.  A query
    is first held against its own cell; its k-th best there is a bar that each
    other cell must be able to reach: no member's angle to the query is less than
    the pivot's less the cell's radius.  The cells left are searched in tiles.
    """
    rows, pivots = _placed(vectors)
    asked = rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").select("cell", F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 9)), "vec_id")
    home = _tiled(rows, asked.withColumn("bar", F.lit(-2.0)), k)
    home = written(home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "vector-home")
    bars = home.where(F.col("rank") == k).select("query_id", F.col("similarity").alias("bar"))
    cells = rows.groupBy("cell").agg(F.max("angle").alias("radius")).orderBy("cell").toPandas()  # PIVOTS rows at most
    number, radius = cells["cell"].to_numpy(), cells["radius"].to_numpy()

    def visits(batches):
        for pdf in batches:
            if len(pdf):
                angle = np.arccos(np.clip(_unit(pdf["vector"]) @ pivots[number].T, -1, 1))
                best = np.cos(np.maximum(angle - radius[None, :], 0))
                i, j = np.nonzero((best >= pdf["bar"].to_numpy()[:, None] - 1e-9) & (number[None, :] != pdf["cell"].to_numpy()[:, None]))
                yield pd.DataFrame({"cell": number[j], "query_id": pdf["query_id"].to_numpy()[i], "vector": pdf["vector"].to_numpy()[i], "bar": pdf["bar"].to_numpy()[i] - 1e-9})

    barred = asked.join(bars, "query_id", "left").select("cell", "query_id", "vector", F.coalesce("bar", F.lit(-2.0)).alias("bar"))
    away = _tiled(rows, barred.mapInPandas(visits, barred.schema), k)
    return home.drop("rank").unionByName(away).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def within(vectors: DataFrame, queries: DataFrame, least: float) -> DataFrame:
    """Vectors of the query's label whose cosine is at least `least`; a label is a
    cell, and a label of many vectors many tiles."""
    rows = vectors.select(F.col("label").alias("cell"), "vec_id", "label", "embedding")
    asked = queries.select(F.col("label").alias("cell"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), F.lit(float(least)).alias("bar"))
    return _tiled(rows, asked)


def best_link(pairs: DataFrame) -> DataFrame:
    best = pairs.groupBy("query_id").agg(F.max(F.struct(F.round("similarity", 9).alias("s"), (-F.col("vec_id")).alias("v"))).alias("b"))
    return best.select("query_id", (-F.col("b.v")).alias("vec_id"), F.col("b.s").alias("similarity"))


def centroids(vectors: DataFrame, by: str) -> DataFrame:
    """Element-wise mean of each group's vectors."""
    parts = vectors.select(by, F.posexplode("embedding").alias("at", "x")).groupBy(by, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda v: v["x"])
    return parts.groupBy(by).agg(ordered.alias("centroid"))


def match_projects(vectors: DataFrame, projects: DataFrame) -> DataFrame:
    """vec_id, project_id, confidence: each vector's most similar project and its
    cosine, the smallest project on a tie.

    projects has project_id and centroid.  BLOCK of them at a time go to the tasks
    that read the vectors, each of which gives one row a vector and block.
    """
    blocks = max(1, -(-projects.count() // BLOCK))
    out = None
    for block in range(blocks):
        part = projects.where(F.pmod(F.xxhash64("project_id"), F.lit(blocks)) == block).select("project_id", "centroid").orderBy("project_id").toPandas()
        ids = part["project_id"].to_numpy()
        q = _unit(part["centroid"])

        def work(batches, q=q, ids=ids):
            for pdf in batches:
                if not len(pdf) or not len(ids):
                    continue
                s = np.round(_unit(pdf["embedding"]) @ q.T, 6)
                best = s.argmax(axis=1)
                yield pdf.__class__({"vec_id": pdf["vec_id"], "project_id": ids[best], "confidence": s[np.arange(len(s)), best]})

        one = vectors.select("vec_id", "embedding").mapInPandas(work, "vec_id long, project_id long, confidence double")
        out = one if out is None else out.union(one)
    best = out.groupBy("vec_id").agg(F.max(F.struct("confidence", (-F.col("project_id")).alias("p"))).alias("b")) if blocks > 1 else None
    return out if best is None else best.select("vec_id", (-F.col("b.p")).alias("project_id"), "b.confidence")


def checked_projects(suggested: DataFrame, projects: DataFrame, sure: float = 0.85) -> DataFrame:
    """suggested(project_id, confidence) with confidence from 0 to 1; a project that
    is not in projects gives way to the first one at 0.5 or less, and what is
    under `sure` is for review."""
    valid = projects.select("project_id").distinct().withColumn("known", F.lit(True))
    first = projects.agg(F.min("project_id").alias("first"))
    rows = suggested.join(valid, "project_id", "left").join(F.broadcast(first))  # one row
    invalid = F.col("known").isNull()
    rows = rows.withColumns({
        "invalid": invalid, "project_id": F.when(invalid, F.col("first")).otherwise(F.col("project_id")),
        "confidence": F.least(F.when(invalid, 0.5).otherwise(1.0), F.greatest(F.lit(0.0), "confidence"))})
    return rows.withColumn("review", F.col("confidence") < sure).drop("known", "first")


def normalize(vectors: DataFrame, slack: float = 0.1) -> DataFrame:
    """Vectors rescaled to length 1 where they are off by more than `slack`."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    off = (F.abs(norm - 1) > slack) & (norm > 0)
    return vectors.withColumn("rescaled", off).withColumn("embedding", F.when(off, F.transform("embedding", lambda x: (x / norm).cast("float"))).otherwise(F.col("embedding")))


def blended(vectors: DataFrame, centers: DataFrame, by: str, own: float = 0.7) -> DataFrame:
    """vectors with blend: `own` parts of each vector and the rest of its group's centroid."""
    both = F.zip_with("embedding", "centroid", lambda x, c: own * x.cast("double") + (1 - own) * c)
    return vectors.join(centers, by).withColumn("blend", both)
