"""Toxicity classifier with counterfactual regularisation (operator 8).

A logistic model over hashed word and word-prefix features.  Beside the log
loss, training penalises how much a sentence's score moves when the identity
term in it is swapped for another (or, where it names none, when a neutral
mention is added), so that naming a group is no evidence by itself.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm import wordblocks as wb
from folio.llm.common import cut, documents, spare, texts

#: Labelled rows that training may take to the driver.
TRAIN_ROWS = 12_000
THRESHOLD = 0.7
SLOTS = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
COUNTERFACTUAL_WEIGHT = 0.5
STEPS, RATE, DECAY = 1500, 0.5, 1e-3
#: Standard deviations by which a feature must exceed its expected toxic rows.
EXCESS = 5.0
LENGTH_POWER, SHARPNESS = 0.75, 5.0
CHUNK = 2 << 20

#: Identity terms that may stand in for each other.
IDENTITY_TERMS = (
    "women men girls boys muslims christians jews hindus buddhists atheists gay straight lesbian bisexual "
    "transgender black white asian african european american mexican immigrants refugees disabled deaf blind "
    "frauen männer muslime christen juden ausländer flüchtlinge femmes hommes musulmans chrétiens juifs étrangers "
    "réfugiés mujeres hombres musulmanes cristianos judíos extranjeros refugiados"
).split()


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slot of every feature, feature count by text): a word and its prefixes."""
    words = wb.split_words(*wb.utf8(column), True, wb.NOT_ALNUM)
    size = words.end - words.begin
    slots, rows = [words.hashes()], [words.row]
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        begin = words.begin[long]
        slots.append(words.hashes(begin, begin + k) + wb.U(k))
        rows.append(rows[0][long])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    slot = (np.concatenate(slots) >> wb.U(64 - 18)).astype(np.int32)[order]
    return slot, np.bincount(row, minlength=len(column))


def _evidence(slot: np.ndarray, count: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of a text's features, by a power of its length so that a long
    text isn't toxic for its length alone."""
    row = np.repeat(np.arange(len(count)), count)
    total = np.bincount(row, weights=weights[slot], minlength=len(count))
    return total / np.maximum(count, 1) ** LENGTH_POWER


def _presence(batches):
    """Documents with each feature, and toxic ones among them, by task."""
    toxic, total = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for batch in wb.text_chunks(batches, "text", CHUNK):
        slot, count = features(batch.column(1))
        pair = np.unique(np.repeat(np.arange(len(count)), count).astype(np.int64) * SLOTS + slot)
        y = batch.column(2).to_numpy()[pair // SLOTS]
        total += np.bincount(pair % SLOTS, minlength=SLOTS)
        toxic += np.bincount(pair % SLOTS, weights=y, minlength=SLOTS).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(toxic[at]), pa.array(total[at])], names=["slot", "toxic", "total"])


def select_features(found: DataFrame, rows: int, toxic: int) -> dict[int, float]:
    """Log ratio of document rates, by slot, of the features whose excess among
    toxic documents is no accident.  At most SLOTS numbers reach the driver."""
    rate = toxic / rows
    counts = found.select("doc_id", "text", "toxic").mapInArrow(_presence, "slot long, toxic long, total long")
    counts = counts.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))
    spread = F.sqrt(F.greatest(F.col("total") * (rate * (1 - rate)), F.lit(0.3)))
    excess = (F.col("toxic") - F.col("total") * rate) / spread
    ratio = F.ln((F.col("toxic") + 1) / (toxic + 2)) - F.ln((F.col("total") - F.col("toxic") + 1) / (rows - toxic + 2))
    chosen = counts.select("slot", excess.alias("excess"), ratio.alias("ratio")).where((F.col("excess") >= EXCESS) & (F.col("ratio") > 0))
    return {r.slot: r.ratio for r in chosen.orderBy("slot").toLocalIterator()}


def counterfactual(text: str, turn: int) -> str:
    """The text with its identity terms swapped, or with a mention added."""
    words, swapped = text.split(" "), False
    for i, word in enumerate(words):
        bare = word.strip(".,;:!?").lower()
        if bare in _IDENTITY:
            other = IDENTITY_TERMS[(_IDENTITY[bare] + 1 + turn % (len(IDENTITY_TERMS) - 1)) % len(IDENTITY_TERMS)]
            words[i], swapped = word.lower().replace(bare, other), True
    if not swapped:
        words.append(IDENTITY_TERMS[turn % len(IDENTITY_TERMS)])
    return " ".join(words)


_IDENTITY = {word: i for i, word in enumerate(IDENTITY_TERMS)}


class Model(NamedTuple):
    weights: np.ndarray  # by feature slot
    gain: float
    bias: float

    def margin(self, slot: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.bias + self.gain * np.log1p(SHARPNESS * _evidence(slot, count, self.weights))


def _matrix(kept: np.ndarray):
    """Texts and their counterfactuals -> the features that have weights."""
    place = np.full(SLOTS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))

    def lists(column):
        slot, count = features(column)
        row = np.repeat(np.arange(len(count)), count)
        at = np.flatnonzero(place[slot] >= 0)
        ends = np.searchsorted(row[at], np.arange(len(count) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(place[slot[at]])), pa.array(count)

    def run(batches):
        for batch in wb.text_chunks(batches, "text", CHUNK):
            turns = batch.column(0).to_pylist()
            twins = pa.array([counterfactual(t, d) for t, d in zip(batch.column(1).to_pylist(), turns)], pa.string())
            own, twin = lists(batch.column(1)), lists(twins)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *own, *twin], names=["doc_id", "toxic", "own", "n_own", "twin", "n_twin"]
            )

    return run


def fit(found: DataFrame) -> Model:
    """Gradient descent on log loss + penalty on counterfactual score changes.

    found has doc_id, text and toxic, a bounded number of rows.  Features are
    counted and looked up on the executors; the driver descends over the few
    that stand out among toxic rows, starting from their log ratios.  No rows,
    or rows of one class only, give the constant score of that rate.
    """
    rows, toxic = found.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = (toxic + 0.5) / (rows + 1.0)
    model = Model(np.zeros(SLOTS), 0.0, float(np.log(rate / (1 - rate))))
    ratio = select_features(found, rows, toxic) if 0 < toxic < rows else {}
    if not ratio:
        return model
    kept, w = np.array(list(ratio)), np.array(list(ratio.values()))
    w = w / np.median(w)
    start = w.copy()
    table = (
        found.select("doc_id", "text", "toxic")
        .mapInArrow(_matrix(kept), "doc_id long, toxic int, own array<int>, n_own long, twin array<int>, n_twin long")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("n_own", "ascending")])
    )
    y = table.column("toxic").to_numpy().astype(np.float64)

    def part(values, count):  # (text, feature, value)
        lists = table.column(values).combine_chunks()
        row = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
        size = np.maximum(table.column(count).to_numpy(), 1)
        return row, lists.flatten().to_numpy(), size[row] ** -LENGTH_POWER

    own, twin = part("own", "n_own"), part("twin", "n_twin")
    gain, bias = 1.0, model.bias
    for _ in range(STEPS):
        e, t = (np.bincount(m[0], weights=w[m[1]] * m[2], minlength=len(y)) for m in (own, twin))
        x, xt = np.log1p(SHARPNESS * e), np.log1p(SHARPNESS * t)
        shift = 2 * COUNTERFACTUAL_WEIGHT * gain * (x - xt)
        error = 1 / (1 + np.exp(-(bias + gain * x))) - y
        push, pull = (error + shift) * gain * SHARPNESS / (1 + SHARPNESS * e), shift * gain * SHARPNESS / (1 + SHARPNESS * t)
        grad = np.bincount(own[1], weights=push[own[0]] * own[2], minlength=len(w))
        grad -= np.bincount(twin[1], weights=pull[twin[0]] * twin[2], minlength=len(w))
        w = np.maximum(w - RATE * (grad / len(y) + DECAY * (w - start)), 0.0)
        gain -= RATE * ((error * x).mean() + (shift * (x - xt)).mean())
        bias -= RATE * error.mean()
    weights = np.zeros(SLOTS)
    weights[kept] = w
    return Model(weights, float(gain), float(bias))


def train(docs: DataFrame, labels: DataFrame, held_out, rows: int = TRAIN_ROWS) -> Model:
    """Fit on the labelled documents that held_out(doc_id) does not hold out.

    At most `rows` labels, those first by hash of doc_id.  A doc_id labelled
    twice is toxic if any label says so; other values than 0 and 1 are ignored.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.where("text is not null").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    return fit(cut(found, "toxicity-sample"))


SCORE = "_toxicity"


def _score(model: Model, name: str):
    def run(batches):
        for batch in wb.text_chunks(batches, "text", CHUNK):
            slot, count = features(batch.column(batch.schema.get_field_index("text")))
            score = 1 / (1 + np.exp(-model.margin(slot, count)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return run


def score_toxicity(docs: DataFrame, model: Model, name: str = SCORE) -> DataFrame:
    """docs with a further column (0 to 1), from each row's whole text.

    A null text is empty and, having no features, scores the model's bias.
    Repeated rows, null ids and further columns do no harm: each row is scored
    by its text alone and keeps its columns.  A column of docs that is called
    `name` already is an error.
    """
    if spare(docs.columns, name) != name:
        raise ValueError(f"the documents have a column {name}")
    return docs.mapInArrow(_score(model, name), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out_rows(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score under THRESHOLD, with their columns, whatever these are called."""
    model, name = train(texts(docs), labels, held_out_rows), spare(docs.columns, SCORE)
    return score_toxicity(docs, model, name).where(F.col(name) < THRESHOLD).drop(name)


def op8_toxicity(spark, sf_dir):
    docs = texts(documents(spark, sf_dir))
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_rows)
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out_rows(F.col("doc_id")).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )
