"""Mixing sources to target weights by iterative proportional fitting
(operator 2).  DataFrame functions only.

Token counts of (source, language, topic) cells are raked until the weighted
marginals meet their targets; documents are then sampled with probabilities
calibrated to a share of all tokens.
"""

from __future__ import annotations

import math
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import cut, documents, spare

DIMENSIONS = ("source", "lang", "topic")
#: Targets, unless given: shares of tokens to this power, rescaled to 1.
TEMPERATURE = 0.5
KEEP = 0.5
ROUNDS, TOLERANCE = 4, 1e-4
MOST_ROUNDS = 40
#: Cells that one task rakes without a shuffle; more are raked across tasks.
ONE_TASK_CELLS = 65_536
SEED = 2
#: Topics, classes of words whose counts tell them, and letters from which a word is a content word.
TOPICS, CLASSES, CONTENT_LETTERS = 8, 32, 5
#: Rounds in which topics are fitted, and words of the corpus that each is given beside its own.
TOPIC_ROUNDS, TOPIC_PRIOR = 6, 1000.0
NO_TOPIC = "none"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def classes_of(words: Column) -> Column:
    """How many content words of a text are in each of CLASSES classes, by hash.

    The classes of all words are written down once, a letter each, and counted
    as text.
    """
    letters = F.array_join(
        F.transform(words, lambda w: F.when(F.length(w) >= CONTENT_LETTERS, F.char(F.pmod(F.hash(w), F.lit(CLASSES)) + 64)).otherwise("")), ""
    )
    size = F.length(letters)
    return F.array(*[(size - F.length(F.replace(letters, F.lit(chr(64 + c)), F.lit("")))).cast("long") for c in range(CLASSES)])


def topic_of(classes: Column, topics: list[list[float]]) -> Column:
    """The number of the topic under which a text's words are likeliest; ties go to
    the lower one, and a text without content words has none.

    The topics' logarithms are one constant array, so the plan is as small for
    many of them.
    """
    logs = F.array(*[F.array(*[F.lit(math.log(x)) for x in shares]) for shares in topics])
    score = lambda shares: F.aggregate(F.zip_with(classes, shares, lambda n, x: n * x), F.lit(0.0), add)
    best = F.transform(F.array(F.transform(logs, score)), lambda scores: F.array_position(scores, F.array_max(scores)))[0]  # bound once
    words = F.aggregate(classes, F.lit(0).cast("long"), add)
    return F.when(words > 0, (best - 1).cast("int"))


def fit_topics(known: DataFrame, count: int = TOPICS, rounds: int = TOPIC_ROUNDS) -> list[list[float]]:
    """The class shares of `count` topics, fitted to all rows of known(classes) by
    classification EM of a mixture of unigrams.

    Topics begin as the corpus, each with every count-th class quadrupled.  Each
    round gives every text its likeliest topic and every topic the shares of its
    texts' words (and TOPIC_PRIOR words of the corpus): one aggregation to a row
    for each topic.
    """
    sums = [F.coalesce(F.sum(F.col("classes")[c]), F.lit(0)).alias(f"c{c}") for c in range(CLASSES)]
    total = [x + 1 for x in known.agg(*sums).first()]
    corpus = [x / sum(total) for x in total]
    raised = [[p * (4 if c % count == k else 1) for c, p in enumerate(corpus)] for k in range(count)]
    topics = [[p / sum(shares) for p in shares] for shares in raised]
    for _ in range(rounds):
        found = known.groupBy(topic_of(F.col("classes"), topics).alias("topic")).agg(*sums).collect()  # a row for each topic
        before = topics
        topics = list(topics)
        for row in found:
            if row.topic is not None:
                own = [row[f"c{c}"] for c in range(CLASSES)]
                topics[row.topic] = [(n + TOPIC_PRIOR * p) / (sum(own) + TOPIC_PRIOR) for n, p in zip(own, corpus)]
        if topics == before:
            break
    return topics


def described(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), source, lang, tokens and classes."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("words", words_of(F.coalesce("row.text", F.lit(""))))
    return rows.select(
        "row",
        F.col("row.source").cast("string").alias("source"),
        F.col("row.lang").cast("string").alias("lang"),
        F.size("words").cast("long").alias("tokens"),
        classes_of(F.col("words")).alias("classes"),
    )


def targets_of(cells: DataFrame, column: str, given: dict | None, temperature: float) -> DataFrame:
    """(value, target): given shares, or tempered shares of tokens; sum 1."""
    spark = cells.sparkSession
    if given:
        total = sum(given.values())
        return spark.createDataFrame([(k, v / total) for k, v in given.items()], "value string, target double")
    marginal = cells.groupBy(F.col(column).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(temperature)).alias("part"))
    total = marginal.agg(F.sum("part")).first()[0] or 1.0
    return marginal.select("value", (F.col("part") / total).alias("target"))


def rake(cells: DataFrame, dimensions=DIMENSIONS, targets: dict | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """Weights of the cells (one column per dimension, and tokens), and miss.

    Each round rescales the weights so that the weighted token shares meet one
    dimension's targets after the other's.  Values without a target get weight
    0; targets of values without tokens can't be met and are shared out by the
    next rescaling.  Ends when all shares are within TOLERANCE of their target,
    or after MOST_ROUNDS: then the targets contradict each other on these cells.
    If targets were given this is an error that names them; the default ones
    are met as well as they can be.  miss is by how much the cell's worst
    marginal misses its target, as a part of the target.
    """
    names = list(dimensions)
    for name in names:
        table = targets_of(cells, name, (targets or {}).get(name), temperature)
        cells = cells.join(table, cells[name].eqNullSafe(table["value"]), "left").drop("value")
        cells = cells.withColumn(f"{name}_target", F.coalesce("target", F.lit(0.0))).drop("target")
    cells = cut(cells.withColumn("weight", F.lit(1.0)), "mix-cells")
    few = cells.count() <= ONE_TASK_CELLS

    def shares(table: DataFrame) -> dict[str, Column]:
        return {n: F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(n)) for n in names}

    for _ in range(MOST_ROUNDS // ROUNDS):
        cells = cells.coalesce(1) if few else cells
        for _turn in range(ROUNDS):
            for name in names:
                share = shares(cells)[name]
                scaled = F.col("weight") * F.col(f"{name}_target") / share
                cells = cells.withColumn("weight", F.when(share > 0, scaled).otherwise(F.lit(0.0)))
        off = [F.when((F.col(f"{n}_target") > 0) & (F.col("weight") > 0), F.abs(s / F.col(f"{n}_target") - 1)).otherwise(0.0) for n, s in shares(cells).items()]
        cells = cut(cells.withColumn("miss", F.greatest(*off, F.lit(0.0))), "mix-weights")
        worst = cells.agg(F.max("miss")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    else:
        if targets:
            raise ValueError(f"the targets for {sorted(targets)} can't be met together: a marginal is off by {worst:.1%} of its target")
    return cells.select(*names, "tokens", "weight", "miss")


def calibrate(cells: DataFrame, keep: float) -> float:
    """The scale at which min(1, scale * weight) keeps that share of the tokens.

    A grid of scales is tried in one aggregation and refined around the answer;
    if the weighted cells hold fewer tokens than wanted, all of them are kept.
    """
    low, high, total = cells.agg(
        F.min(F.when(F.col("weight") > 0, F.col("weight"))), F.max("weight"), F.sum("tokens")
    ).first()
    if not low or not total:
        return 0.0
    left, right = 0.0, 1.0 / low
    for turn in range(4):
        if turn:
            grid = [left + (right - left) * i / 32 for i in range(33)]
        else:
            first = keep / max(high, 1e-300) * 1e-3
            grid = [0.0] + [first * (right / first) ** (i / 63) for i in range(64)]
        kept = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * s)).alias(f"s{i}") for i, s in enumerate(grid)]).first()
        above = [i for i, x in enumerate(kept) if x >= keep * total]
        if not above:
            return grid[-1]
        left, right = grid[max(above[0] - 1, 0)], grid[above[0]]
    return right


def chances(docs: DataFrame, dimensions=DIMENSIONS, targets: dict | None = None, keep: float = KEEP, seed: int = SEED) -> DataFrame:
    """row (all columns of docs), source, lang, topic, tokens, weight, miss,
    probability and sampled, for each row of docs.

    A document's draw is a hash of its doc_id and text, so reruns and lost
    executors repeat it.  A null source or language is a value of its own; null
    and empty texts have no tokens and are sampled like their cell.  Cells
    without tokens weigh nothing.  Repeated rows get the same draw.  The columns
    of docs are kept apart, in row, so their names don't matter.  An empty table
    gives an empty one.
    """
    rows = described(docs)
    known = cut(rows.select("source", "lang", "tokens", "classes"), "mix-documents")
    number = topic_of(F.col("classes"), fit_topics(known))
    topic = F.coalesce(F.concat(F.lit("topic"), number), F.lit(NO_TOPIC))
    names = list(dimensions)
    cells = cut(known.withColumn("topic", topic).groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mix-counts")
    weights = cut(rake(cells, dimensions, targets), "mix-raked")
    scale = calibrate(weights, keep)
    table = weights.select(
        *[F.col(n).alias(f"{n}_cell") for n in names], "weight", "miss", F.least(F.lit(1.0), F.col("weight") * scale).alias("probability")
    )
    rows = rows.withColumn("topic", topic).drop("classes")
    same = None
    for n in names:
        one = F.col(n).eqNullSafe(F.col(f"{n}_cell"))
        same = one if same is None else same & one
    draw = F.shiftrightunsigned(F.xxhash64("row.doc_id", "row.text", F.lit(seed)), 11) / float(1 << 53)
    rows = rows.join(table, same, "left").drop(*[f"{n}_cell" for n in names])
    return rows.withColumn("sampled", F.coalesce(draw < F.col("probability"), F.lit(False)))


def mix_sources(docs: DataFrame, targets: dict | None = None, keep: float = KEEP, seed: int = SEED) -> DataFrame:
    """The sampled rows of docs, with its columns and mix_weight (mix_weight_
    where docs has a column of that name)."""
    name = spare(docs.columns, "mix_weight")
    return chances(docs, targets=targets, keep=keep, seed=seed).where("sampled").select("row.*", F.col("weight").alias(name))


def op2_mixing(spark, sf_dir):
    rows = chances(documents(spark, sf_dir))
    return rows.select("row.doc_id", "source", "lang", "topic", F.col("tokens").alias("n_tokens"), "weight", "probability", "sampled", "miss")
