"""Structured Streaming forms of the event reports.

Each operator takes a (streaming) DataFrame of task events and returns one; run()
drives a stream over what is there and gives its result as a table.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folio.sources.storage import drop, shared_path

WATERMARK = "10 minutes"
#: Overall status, the first that applies.
PRECEDENCE = ("failed", "cancelled", "retrying", "completed", "in_progress", "pending")


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def run(stream: DataFrame, mode: str, name: str, folder: str | None = None) -> DataFrame:
    """Run a stream until it has read all input, and read what it wrote.

    complete results replace each other; append and update results are kept by
    batch, and a batch that is delivered again replaces itself.  Offsets, state
    and results are in `folder` (by default a fresh one in the shared folder); a
    query started again on the same folder goes on where it was.
    """
    spark = stream.sparkSession
    folder = folder or shared_path(spark, f"stream-{name}")
    path = f"{folder}/result"

    def put(df: DataFrame, batch: int) -> None:
        here = path if mode == "complete" else f"{path}/batch={batch}"
        df.write.mode("overwrite").parquet(here)
        if batch and mode != "complete" and spark.read.schema(df.schema).parquet(here).isEmpty():
            drop(spark, here)  # of a batch that just moved the watermark

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").foreachBatch(put).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(path)


def delivered(deliveries: list[DataFrame], build, mode: str, name: str) -> DataFrame:
    """What a stream over a folder gives when deliveries come in one after another.

    build makes the stream of the events; each delivery is added to the folder and
    taken in before the next, in micro-batches of its own, while state, offsets
    and watermark go on from one to the next.
    """
    spark = deliveries[0].sparkSession
    source, folder = shared_path(spark, f"deliveries-{name}"), shared_path(spark, f"stream-{name}")
    for part in deliveries:
        part.write.mode("append").parquet(source)
        out = run(build(read_events(spark, source, part.schema)), mode, name, folder)
    return out


def windowed(events: DataFrame, length: str, slide: str | None = None, *keys: str) -> DataFrame:
    """Runs, failures and time by window (and key), late events up to WATERMARK."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    rows = events.withWatermark("ts", WATERMARK).groupBy(window.alias("w"), *keys)
    return rows.agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failures"), F.sum("cents").alias("total_cents")
    ).select(F.col("w.start").alias("start"), *keys, "runs", "failures", "total_cents")


def first_deliveries(events: DataFrame, keys: list[str], within: str = "1 hour") -> DataFrame:
    """Each key once, however often it is delivered within the watermark.

    A key is remembered until the watermark (the latest event time less `within`)
    passes its first event by `within`; the next copy then counts as new.  A copy
    older than the watermark is late and never given out.
    """
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(keys)


STATUS = "document_id long, overall_status string, stages_completed string, error_count long, first_us long, last_us long"
LAST_STAGE = "relationship_building"


def overall_status(latest: str, stage: str, done: int) -> str:
    """The first of PRECEDENCE that holds, for the latest event and the number of stages done."""
    holds = {
        "failed": latest == "failed", "cancelled": latest == "cancelled", "retrying": latest == "retrying", "completed": latest == "completed" and stage == LAST_STAGE,
        "in_progress": done > 0 or latest == "started", "pending": True,
    }
    return next(s for s in PRECEDENCE if holds[s])


def _fold(key, frames, state: GroupState):
    """Status of one document from all its events so far, whatever their order."""
    stages, errors, first, last, last_id, latest, stage = state.get if state.exists else ("", 0, 1 << 62, 0, -1, "", "")
    done = set(filter(None, stages.split(",")))
    for pdf in frames:
        done |= set(pdf.loc[pdf["state"] == "completed", "stage"])
        errors += int((pdf["state"] == "failed").sum())
        first = min(first, int(pdf["us"].min()))
        top = pdf.sort_values(["us", "event_id"]).iloc[-1]
        if (int(top["us"]), int(top["event_id"])) > (last, last_id):
            last, last_id, latest, stage = int(top["us"]), int(top["event_id"]), top["state"], top["stage"]
    state.update((",".join(sorted(done)), errors, first, last, last_id, latest, stage))
    yield pd.DataFrame([(key[0], overall_status(latest, stage, len(done)), ",".join(sorted(done)), errors, first, last)], columns=[c.split()[0] for c in STATUS.split(", ")])


def status_fold(events: DataFrame) -> DataFrame:
    """Current status by document, kept as state and given out at each change.

    events has document_id, event_id, ts, stage and state (failed, cancelled,
    retrying, started or completed).
    """
    rows = events.withColumn("us", F.unix_micros("ts"))
    state = "stages string, errors long, first long, last long, last_id long, latest string, stage string"
    return rows.groupBy("document_id").applyInPandasWithState(_fold, STATUS, state, "update", GroupStateTimeout.NoTimeout)


GATE = "document_id long, failures long, last_us long, events long"


def _counted(failures: int, last: int, events: list) -> tuple[int, int]:
    """Failures since the last success, and when the last was, after more events."""
    for us, _, status in sorted(events):
        if status == "failed":
            failures, last = failures + 1, us
        elif status == "completed":
            failures, last = 0, 0
    return failures, last


def _gate(key, frames, state: GroupState):
    """The gate of one document.  Events behind the watermark, which none can come
    before any more, are counted for good; later ones are held in order until
    then, and give the result so far together with those."""
    failures, last, seen, held = state.get if state.exists else (0, 0, 0, "[]")
    held = [tuple(x) for x in json.loads(held)]
    new = [] if state.hasTimedOut else [x for pdf in frames for x in zip(pdf["us"].tolist(), pdf["event_id"].tolist(), pdf["status"].tolist())]
    held, settled = held + new, state.getCurrentWatermarkMs() * 1000
    failures, last = _counted(failures, last, [x for x in held if x[0] < settled])
    held = sorted(x for x in held if x[0] >= settled)
    state.update((failures, last, seen + len(new), json.dumps(held)))
    if held:
        state.setTimeoutTimestamp(max(held[0][0] // 1000, state.getCurrentWatermarkMs()) + 1)
    if new:
        yield pd.DataFrame([(key[0], *_counted(failures, last, held), seen + len(new))], columns=[c.split()[0] for c in GATE.split(", ")])


def failure_gate(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Failures in a row by document and when the last was, given out at each
    change with the number of events counted so far.

    Events may come in any order within `delay` of the latest: the result is that
    of all of them in order of (ts, event_id).  Older ones are late and left out.
    State holds a document's events of that span.
    """
    rows = events.withColumn("us", F.unix_micros("ts")).withWatermark("ts", delay).select("document_id", "event_id", "status", "us", "ts")
    return rows.groupBy("document_id").applyInPandasWithState(_gate, GATE, "failures long, last long, seen long, held string", "update", GroupStateTimeout.EventTimeTimeout)


def latest_gates(changes: DataFrame) -> DataFrame:
    """The last change of each document."""
    return changes.groupBy("document_id").agg(F.max_by(F.struct("failures", "last_us"), "events").alias("r")).select("document_id", "r.*")


def blocked(gates: DataFrame, as_of: DataFrame, least: int = 3, seconds: int = 300) -> DataFrame:
    """gates with blocked: `least` failures, the last at most `seconds` before as_of (one row)."""
    fresh = F.col("as_of_us") - F.col("last_us") <= seconds * 1_000_000
    return gates.join(F.broadcast(as_of)).withColumn("blocked", (F.col("failures") >= least) & fresh).drop("as_of_us")  # one row


def streaks(events: DataFrame, gap: str, least: int, *keys: str) -> DataFrame:
    """Sessions of events no further apart than `gap`, of at least `least`."""
    rows = events.withWatermark("ts", WATERMARK)
    found = rows.groupBy(F.session_window("ts", gap).alias("w"), *keys).agg(F.count("*").alias("events"))
    return found.where(F.col("events") >= least).select(*keys, F.col("w.start").alias("start"), "events")


def latest_states(events: DataFrame) -> DataFrame:
    """A batch's documents with the status of their latest event."""
    return events.groupBy("batch_id", "document_id").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"), F.min("ts").alias("first"), F.max("ts").alias("last"))
