"""Readers, writers and table edits on Spark file formats."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see: under
    spark.checkpoint.dir.  Where that is unset, one of our own in local mode,
    whose tasks share the driver's disk; an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="folio-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/folio/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows as a table in the shared folder: it ends the lineage where a lost
    executor can't reach, and the planner knows its size."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Media types that are taken in, by file extension.
MIME = {
    "pdf": "application/pdf",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}


def scan_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue of the files under path whose type is taken in: name, size in
    bytes and MB, hash, media type, time.  Contents are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kind = F.try_element_at(F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair]), F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)))
    rows = files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.round(F.col("length") / 1048576, 2).alias("size_mb"), F.sha2("content", 256).alias("content_hash"),
        kind.alias("mime"), F.col("modificationTime").alias("modified"))
    return rows.where("mime is not null")


def write_files(lines: DataFrame, path: str) -> None:
    """Write lines(file, place, value) as text files of the given names; a file's
    lines are in the order of place, in one task."""
    spark = lines.sparkSession
    lines.repartition("file").sortWithinPartitions("file", "place").select("file", "value").write.partitionBy("file").text(path)
    for name in partition_values(spark, path, "file"):
        system, at = _files(spark, f"{path}/file={name}")
        part = next(f.getPath() for f in system.listStatus(at) if f.getPath().getName().startswith("part-"))
        system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        drop(spark, f"{path}/file={name}")


def read_manifest(spark: SparkSession, path: str, item: str) -> DataFrame:
    """A row for each file of import manifests with a nested list of files."""
    schema = f"batch_id bigint, project_id bigint, files array<struct<{item}>>"
    return spark.read.schema(schema).json(path).select("batch_id", "project_id", F.inline("files"))


def read_event_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; malformed ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def update_rows(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """table with the columns of changes put in place where the key is there."""
    new = changes.select(key, *[F.col(c).alias(f"_{c}") for c in changes.columns if c != key], F.lit(True).alias("_hit"))
    rows = table.join(new, key, "left")
    cols = [F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in changes.columns and c != key else F.col(c) for c in table.columns]
    return rows.select(*cols)


def delete_rows(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(gone.select(*keys).distinct(), keys, "left_anti")


def cascade(gone: DataFrame, tables: dict[str, DataFrame], key: str) -> dict[str, DataFrame]:
    """The tables, in the order given, without the rows of keys that are gone."""
    return {name: delete_rows(rows, gone, [key]) for name, rows in tables.items()}


def insert_ignore(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """table and those rows of new whose key it lacks; of rows with one new key
    the smallest stays."""
    fresh = delete_rows(new, table, keys)
    rest = [c for c in table.columns if c not in keys]
    one = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*table.columns)
    return table.unionByName(one)


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """table with rows of new put in place of those with the same key."""
    rows = table.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)))
    rest = [c for c in table.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct("_v", *rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}") for c in rest]).select(*table.columns)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _files(spark, path)
    return system.exists(at)


def drop(spark: SparkSession, path: str) -> None:
    system, at = _files(spark, path)
    system.delete(at, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values a table is partitioned by, in order: one name a partition."""
    system, at = _files(spark, path)
    names = [f.getPath().getName() for f in system.listStatus(at)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def _replace(rows: DataFrame, path: str, column: str) -> None:
    """Put rows in place of those partitions of a table that rows has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def retire(spark: SparkSession, path: str, archive: str, column: str, first: str) -> list[str]:
    """Move the partitions before `first` from a table to its archive; their values.

    They are copied as whole partitions and dropped once all are there, so a move
    that was broken off can be made again: a partition replaces its own copy.
    """
    old = [v for v in partition_values(spark, path, column) if v < first]
    if old:
        rows = spark.read.parquet(path)
        _replace(rows.where(F.col(column).cast("string") < first), archive, column)
        drop_partitions(spark, path, column, old)
    return old


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    for value in values:
        drop(spark, f"{path}/{column}={value}")


def prune(spark: SparkSession, path: str, column: str, ts: str, before, dry_run: bool = False) -> int:
    """Delete the rows of a partitioned table whose ts is before a time; how many.

    Partitions of whole days before it are dropped, the day it lies in is written
    anew with the rows that stay, and no other is read.  A dry run just counts.
    """
    rows, day = spark.read.parquet(path), before.date().isoformat()
    upto = rows.where((F.col(column).cast("string") <= day) & (F.col(ts) < F.lit(before)))
    gone = upto.count()
    if gone and not dry_run:
        stay = written(rows.where((F.col(column).cast("string") == day) & (F.col(ts) >= F.lit(before))), "prune")
        empty = stay.isEmpty()
        drop_partitions(spark, path, column, [v for v in partition_values(spark, path, column) if v < day or (v == day and empty)])
        if not empty:
            _replace(stay, path, column)
    return gone


def checked(lines: DataFrame, schema: str, rules: dict[str, str], line: str = "value") -> DataFrame:
    """JSON lines read by a declared schema: its fields, `corrupt` (the line, where
    it doesn't fit) and `errors`, what is wrong with it.

    A line that is no JSON object is `malformed`; a field that is absent or null
    is `missing: field`, one whose value has another type `type: field`; a rule
    that doesn't hold is `rule: name`.  Rules look at rows without other errors.
    """
    fields = schema_of(schema)
    typed = F.from_json(line, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.select(typed.alias("t"), F.from_json(line, "map<string,string>").alias("raw"), F.col(line).alias("_line"))
    malformed = F.col("raw").isNull() | (F.size("raw") == 0)
    said = [F.when(malformed, F.lit("malformed"))]
    for f in fields:
        told = F.try_element_at("raw", F.lit(f))
        said += [F.when(~malformed & told.isNull(), F.lit(f"missing: {f}")), F.when(told.isNotNull() & F.col(f"t.{f}").isNull(), F.lit(f"type: {f}"))]
    rows = rows.withColumn("errors", F.array_compact(F.array(*said)))
    rows = rows.select(*[F.col(f"t.{f}").alias(f) for f in fields], F.when(F.size("errors") > 0, F.col("_line")).alias("corrupt"), "errors")
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(holds), F.lit(False)), F.lit(f"rule: {name}")) for name, holds in rules.items()]))
    return rows.withColumn("errors", F.when(F.size("errors") == 0, broken).otherwise(F.col("errors")))


def schema_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def validation_report(rows: DataFrame, table: str) -> DataFrame:
    """name, n, share and fix of rows with `errors`: all, valid and invalid rows
    with their share, and each kind of error with the rows that have it."""
    bad = F.size("errors") > 0
    totals = rows.agg(F.count("*").alias("all"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))
    share = lambda n: F.when(F.col("all") > 0, F.col(n) * 100.0 / F.col("all")).otherwise(0.0)
    kinds = F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n"), share(n).alias("share"), F.lit("").alias("fix")) for n in ("all", "valid", "invalid")]))
    errors = rows.select(F.explode("errors").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    what = F.substring_index("name", ": ", -1)
    fix = F.when(F.col("name").startswith("missing"), F.concat(F.lit("add "), what)).when(F.col("name").startswith("type"), F.concat(F.lit("convert "), what)).otherwise("")
    errors = errors.join(F.broadcast(totals.select("all"))).select("name", "n", share("n").alias("share"), fix.alias("fix"))  # one row
    return totals.select(kinds).unionByName(errors).select(F.lit(table).alias("table"), "*")
