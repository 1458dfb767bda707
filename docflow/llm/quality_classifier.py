"""Operator 9: a quality score learned from preferences (Bradley-Terry).

A labelled good document is preferred to a labelled bad one. The score of a document is a
weighted sum of its features, and the probability that a is preferred to b is the logistic
function of the difference of their scores; the weights minimise the logistic loss on
feature differences of sampled pairs. The cut between good and bad is the quantile of the
scores at the share that label 0 has; scores are reported as the logistic function of
their distance from the cut, so 0.5 is the cut.

Every labelled row takes part: the rows of the rarer label meet those of the other in turn, by
their places in hash order, ROUNDS times each, and the cut counts the scores of all. Texts are
read once for the features; what is fitted on are features, differences and scores, in tables
of their own, of which the driver sees sums only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import doc_crc, documents, forget, numbered, ranked, saved, widened
from docflow.llm.measures import measure

PAIRS = 120_000  # of a fit in memory
ROUNDS = 2  # pairs of each row of the more frequent label
BINS = 1024
RIDGE = 1e-3
STEPS = 40


def features(block: w.Block) -> np.ndarray:
    """A row of features for each text; all finite, also for an empty text."""
    m = {k: v.astype(np.float64) for k, v in measure(block).items()}
    words, chars, lines = m["n_words"] + 1, m["word_chars"] + 1, m["n_lines"] + 1
    shares = [
        m["n_symbols"] / chars, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, m["n_pairs_again"] / words,
        m["n_again"] / words, m["n_upper"] / chars, m["n_digits"] / chars, m["n_marks"] / chars,
    ]
    sizes = [np.log(words), np.log(lines), np.log(chars / words), np.log(words / lines)]
    return np.stack([*shares, *[np.sqrt(s) for s in shares], *sizes], axis=1)


@dataclass
class Ranker:
    """mean and scale standardise features; weights and cut as fitted."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weights - self.cut

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def sums(d: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row for each feature: slope and curve of the pairwise logistic loss over differences d,
    summed, and the number of pairs; what parts of the pairs give can be added up."""
    p = 1 / (1 + np.exp(np.clip(d @ weights, -30, 30)))
    count = np.full((d.shape[1], 1), len(d), dtype=np.float64)
    return np.hstack([-(d.T @ p)[:, None], (d.T * (p * (1 - p))) @ d, count])


def newton(width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights that minimise the loss; `of` gives the sums over all pairs at some weights."""
    weights = np.zeros(width)
    for _ in range(STEPS):
        total = of(weights)
        total = total[:, :-1] / total[0, -1]
        slope, curve = total[:, 0] + RIDGE * weights, total[:, 1:] + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(x: np.ndarray, good: np.ndarray, share_bad: float, pairs: int = PAIRS, seed: int = 7) -> Ranker:
    """Fit on feature rows and their labels; without both labels every score is 0.5."""
    width = x.shape[1]
    if good.all() or not good.any():
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.clip((x - mean) / scale, -6, 6)
    rng = np.random.default_rng(seed)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    d = z[rng.choice(up, pairs)] - z[rng.choice(down, pairs)]
    weights = newton(width, lambda weights: sums(d, weights))
    raw = z @ weights
    # Each label's rows count as much as the label does among all labelled rows.
    each = np.where(good, (1 - share_bad) / good.sum(), share_bad / (~good).sum())
    order = np.argsort(raw)
    below = int(np.searchsorted(np.cumsum(each[order]), share_bad - 1e-12))
    pair = raw[order[[below, min(below + 1, len(order) - 1)]]]
    return Ranker(mean, scale, weights, float(pair.mean()))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and features `x` of every row; a null text counts as the empty one."""

    def of(batch: pa.RecordBatch) -> list:
        x = [features(b) for b in w.blocks(batch.column("text"))]
        flat = np.concatenate(x).ravel() if x else np.zeros(0)
        width = len(flat) // max(batch.num_rows, 1)
        offsets = pa.array(np.arange(batch.num_rows + 1) * width, pa.int32())
        return [pa.ListArray.from_arrays(offsets, pa.array(flat))]

    return widened(docs.select("doc_id", "text"), [("x", "array<double>")], of, without=("text",))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1)


def _total(rows: DataFrame, column: str, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of what `of` gives of the batches of an array column; one small row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [of(_matrix(batch.column(0))) for batch in batches if batch.num_rows]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, axis=0).ravel()])], names=["total"])

    found = rows.select(column).mapInArrow(run, "total array<double>").toArrow().column("total")
    return _matrix(found.combine_chunks()).sum(axis=0)


def paired(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Features `up` of a good row and `down` of a bad one, so that each row is in some pair.

    rows is (quality, x, place), the places gapless from 0 within each label.
    """
    rare = min(counts, key=lambda q: (counts[q], q))
    names = ("down", "up") if rare == 0 else ("up", "down")
    few = rows.filter(F.col("quality") == rare).select(F.col("place").alias("mate"), F.col("x").alias(names[0]))
    turns = F.explode(F.sequence(F.lit(0), F.lit(ROUNDS - 1)))
    many = rows.filter(F.col("quality") != rare).select(F.col("x").alias(names[1]), "place", turns.alias("turn"))
    mate = (F.col("place") + F.col("turn") * (counts[rare] // ROUNDS)) % counts[rare]
    return many.withColumn("mate", mate).join(few, "mate").select("up", "down")


def cut_at(raw: DataFrame, counts: dict[int, int], share_bad: float) -> float:
    """Where the bad rows' share of all weight is below, by raw (quality, raw) of all rows.

    Each label's rows count as much as the label does among all labelled rows. Rows are counted
    in bins, and the bin that has the place in bins again, until it holds one value.
    """
    weight = {0: share_bad / counts[0], 1: (1 - share_bad) / counts[1]}
    goal, below = share_bad - 1e-12, 0.0
    numbers = [F.count_if(F.col("quality") == q).alias(f"n{q}") for q in (0, 1)]
    ends = [F.min("raw").alias("least"), F.max("raw").alias("most")]
    found = raw.agg(*ends, *numbers).first()
    while found["least"] < found["most"]:
        least, most = found["least"], found["most"]
        place = F.floor((F.col("raw") - least) / F.lit(most - least) * BINS)
        inside = raw.filter(F.col("raw").between(least, most)).groupBy(F.least(place, F.lit(BINS - 1)).alias("bin"))
        for found in sorted(inside.agg(*ends, *numbers).collect(), key=lambda r: r["bin"]):
            held = sum(weight[q] * found[f"n{q}"] for q in (0, 1))
            if below + held >= goal:
                break
            below += held
        else:
            below -= held
    value, held = found["least"], sum(weight[q] * found[f"n{q}"] for q in (0, 1))
    if below + held - weight[1 if found["n1"] else 0] >= goal:  # another row of this value follows
        return value
    above = raw.filter(F.col("raw") > value).agg(F.min("raw")).first()[0]
    return value if above is None else (value + above) / 2


def learn(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on `docs` that `labels` (doc_id, quality) marks 0 or 1; other labels are left out."""
    x = saved(measured(docs), "features")
    ranker = learned(x, labels)
    forget(x)
    return ranker


def learned(x: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on all rows of x (doc_id, x) that labels mark; without both labels every score is 0.5."""
    marked = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    share = marked.agg(F.avg(1 - F.col("quality"))).first()[0]
    rows = x.join(marked, "doc_id").withColumn("spread", F.xxhash64("doc_id", "x"))
    rows = saved(ranked(rows, ["quality"], ["doc_id"], "spread", "place").select("quality", "x", "place"), "labelled")
    counts = {q: n for q, n in rows.groupBy("quality").count().collect()}
    if len(counts) < 2:
        forget(rows)
        width = features(next(w.blocks(pa.array([""])))).shape[1]
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    n = sum(counts.values())
    mean = _total(rows, "x", lambda x: x.sum(axis=0)) / n
    scale = np.sqrt(_total(rows, "x", lambda x: ((x - mean) ** 2).sum(axis=0)) / n) + 1e-9
    whole = Ranker(mean, scale, np.zeros(len(mean)), 0.0)

    def apart(batch: pa.RecordBatch) -> list:
        d = whole.scaled(_matrix(batch.column("up"))) - whole.scaled(_matrix(batch.column("down")))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32()), pa.array(d.ravel()))]

    pairs = saved(widened(paired(rows, counts), [("d", "array<double>")], apart, without=("up", "down")), "pairs")
    width = len(mean)
    weights = newton(width, lambda at: _total(pairs, "d", lambda d: sums(d, at)).reshape(width, -1))
    forget(pairs)
    whole = Ranker(mean, scale, weights, 0.0)
    raw = saved(widened(rows, [("raw", "double")], lambda b: [pa.array(whole.raw(_matrix(b.column("x"))))], without=("x", "place")), "raw")
    cut = cut_at(raw, counts, share)
    forget(rows, raw)
    return Ranker(mean, scale, weights, cut)


def scored(docs: DataFrame, ranker: Ranker, keep_text: bool = True) -> DataFrame:
    """docs with score (0 to 1); a null text is scored as the empty text."""

    def of(batch: pa.RecordBatch) -> list:
        s = [ranker.score(features(b)) for b in w.blocks(batch.column("text"))]
        return [pa.array(np.concatenate(s) if s else np.zeros(0), pa.float64())]

    return widened(docs, [("score", "double")], of, without=() if keep_text else ("text",))


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of 0.5 or more, with their own columns.

    Repeated rows are judged alike; extra columns pass through, also one named score.
    """
    inner = numbered(docs)
    ranker = learn(docs, labels)
    return scored(inner, ranker).filter("score >= 0.5").select(*inner.columns).toDF(*docs.columns)


def op9_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score from a ranker that learned from the rows not held out."""
    x = saved(measured(documents(spark, sf_dir)), "features")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(doc_crc("doc_id") % 3 != 1)
    ranker = learned(x, labels)
    out = widened(x, [("score", "double")], lambda batch: [pa.array(ranker.score(_matrix(batch.column("x"))))], without=("x",))
    held = F.coalesce(doc_crc("doc_id") % 3 == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
