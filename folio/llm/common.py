"""Shared plumbing: input projection, cut points in the lineage, row helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Spark's setting to delete a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where none is set, one of our own in local mode, whose tasks share the
    driver's disk; an error on a cluster, whose executors don't.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_folder(spark)}/folio/{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back.

    The written table ends the lineage where a lost executor can't reach, and
    its size is known to the planner when it chooses between join strategies.
    The shuffle files of the write are deleted with its end, as nothing reads
    them again.
    """
    spark = df.sparkSession
    path = f"{written_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables that cut() wrote in this application.

    Results are lazy and read them, so this is for when those are consumed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(written_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spare(taken, name: str) -> str:
    """name, with underscores added until no column in `taken` is called so."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name += "_"
    return name


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text) under those names, whatever else the table carries."""
    if (id_col, text_col) == ("doc_id", "text") and docs.schema["doc_id"].dataType.typeName() == "long":
        return docs.select("doc_id", "text")  # as it is, so that equal shuffles are recognised as one
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def group_rows(batches, keys: list[str]):
    """Yield (key values, table) for runs of equal keys in sorted Arrow batches."""
    import pyarrow as pa

    held, key = [], None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*columns))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if key is not None and rows[start] != key:
                    yield key, pa.Table.from_batches(held)
                    held = []
                key = rows[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield key, pa.Table.from_batches(held)
