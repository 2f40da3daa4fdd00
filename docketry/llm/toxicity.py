"""Toxicity by a factorisation machine over hashed terms.

Terms are the distinct words of a text and their first four and five letters, lower-cased and hashed into
``2 ** BITS`` buckets. The machine scores a text as a bias, a weight per term and, for each pair of terms, the
product of their factors: a pair such as an insult with a mention of a group can count for more than its two
words do apart, also where neither weighs anything alone. Weights are trained with follow-the-regularised-leader
and an L1 penalty, so that the many neutral terms weigh nothing however long a text is; the factors of all terms
are trained beside them with AdaGrad. For the pairs a text is a vector of length one, so the sum of its pairs is
divided by the number of its terms and does not grow with the text. Terms in fewer than ``MIN_ROWS`` training rows are left out. Training uses about ``per_class`` rows of each label, those whose hashed id
lies below a share of the range; every fifth of them is kept back to calibrate the scores.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import annotate, col, place, share_of, struct_array

BITS = 22
FACTORS = 8
PER_CLASS = 4000
MIN_ROWS = 3
CALIBRATE = 5
THRESHOLD = 0.3
# Words a worker remembers with what they stand for.
REMEMBERED = 500_000

_WORD = re.compile(r"[^\W\d_]+")


def buckets(word: str) -> set[int]:
    """The hashed terms of one lower-cased word."""
    raw = {f"w {word}"}
    raw.update(f"p {word[:n]}" for n in (4, 5) if len(word) > n)
    return {zlib.crc32(t.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for t in raw}


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Machine:
    """``place`` maps a bucket to its row of ``weight`` and ``factor``; buckets that training left out are absent."""

    place: dict[int, int]
    weight: np.ndarray
    factor: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)

    def raw(self, at: np.ndarray) -> float:
        v = self.factor[at]
        total = v.sum(axis=0)
        return float(self.bias + self.weight[at].sum() + 0.5 * (total @ total - (v * v).sum()) / max(1, len(at)))

    def score(self, at: np.ndarray) -> float:
        """The calibrated probability for distinct rows ``at``."""
        a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.raw(at) + b, -30, 30))))


def train(rows: list[tuple[np.ndarray, int]], classes: tuple[int, int], alpha=0.1, beta=1.0, l1=4.0, l2=1.0, rate=0.02, decay=1e-3, epochs=5) -> Machine:
    """``rows`` are arrays of distinct buckets with a label; ``classes`` how many rows of each label stand behind them."""
    if not rows:
        return Machine({}, np.zeros(0), np.zeros((0, FACTORS)), -4.0)
    every, seen = np.unique(np.concatenate([r for r, _ in rows]), return_counts=True)
    used = every[seen >= MIN_ROWS]
    row_of = {int(b): i for i, b in enumerate(used)}
    data = [(np.array([row_of[int(b)] for b in r if int(b) in row_of], np.int64), y) for r, y in rows]
    random = np.random.default_rng(11)
    d = len(used)
    z, n = np.zeros(d), np.zeros(d)
    v, g2 = random.normal(0, 0.02, (d, FACTORS)), np.full((d, FACTORS), 1e-3)
    positive = sum(y for _, y in rows)
    # Rows are weighted back to the share of each label among all learnable rows.
    weigh = [classes[0] / max(1, len(rows) - positive), classes[1] / max(1, positive)]
    top = max(weigh) or 1.0
    weigh = [w / top for w in weigh]
    bias, bias_n = float(np.log((classes[1] + 1) / (classes[0] + 1))), 1.0

    def weights(at):
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for r in random.permutation(len(data)):
            at, y = data[r]
            w = weights(at)
            f = v[at]
            total = f.sum(axis=0)
            size = max(1, len(at))
            raw = bias + w.sum() + 0.5 * (total @ total - (f * f).sum()) / size
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) * weigh[y]
            bias_n += error * error
            bias -= 0.1 * error / np.sqrt(bias_n)
            step = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / alpha
            z[at] += error - step * w
            n[at] += error * error
            grad = error * (total - f) / size + decay * f
            g2[at] += grad * grad
            v[at] -= rate * grad / np.sqrt(g2[at])
    return Machine(row_of, weights(np.arange(d)), v, bias)


def calibrate(machine: Machine, rows: list[tuple[np.ndarray, int]], classes: tuple[int, int]) -> tuple[float, float]:
    """Slope and offset of a logistic fit to the raw scores of rows kept back, by Newton steps with a small ridge."""
    if len({y for _, y in rows}) < 2:
        return 1.0, 0.0
    raw = np.array([machine.raw(_known(machine, r)) for r, _ in rows])
    y = np.array([y for _, y in rows], float)
    share = [classes[0] / max(1, (y == 0).sum()), classes[1] / max(1, (y == 1).sum())]
    weight = np.where(y == 1, share[1], share[0])
    weight = weight / weight.mean()
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    theta = np.array([1.0, 0.0])
    ridge = np.diag([1.0, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ (theta - [1.0, 0.0])
        theta = theta - np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge, grad)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 and np.isfinite(theta).all() else (1.0, 0.0)


def _known(machine: Machine, found: np.ndarray) -> np.ndarray:
    return np.array([machine.place[int(b)] for b in found if int(b) in machine.place], np.int64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learnable: Column, per_class: int = PER_CLASS) -> Machine:
    """Train on learnable rows of ``labels`` joined to their texts; null labels and ids teach nothing.

    ``learnable`` is a condition on the id column. Where one id has several labels, the largest counts.
    """
    marked = (
        labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .withColumnRenamed("id", id_col)
        .filter(learnable)
    )
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    # About per_class ids of each label, so this is a small table.
    chosen = marked.filter(place(col(id_col)) < share_of(F.col("label"), counts, per_class))
    texts = docs.select(col(id_col), col(text_col).cast("string").alias("__text")).join(F.broadcast(chosen), id_col)

    def start():
        def score(rows: list[str | None]) -> pa.StructArray:
            found = [np.array(sorted(set().union(*map(buckets, words(t)))), np.int32) for t in rows]
            return struct_array(buckets=pa.array([f.tobytes() for f in found], pa.binary()))

        return score

    terms = annotate(texts, [F.col("__text")], "terms", T.StructType([T.StructField("buckets", T.BinaryType())]), start, [id_col, "label"])
    # One row of each id, so that repeated rows cannot widen the sample.
    rows = terms.groupBy(col(id_col), "label").agg(F.min("terms.buckets").alias("buckets"))
    got = sorted((r[0], r[1], bytes(r["buckets"])) for r in rows.collect())
    data = [(np.frombuffer(b, np.int32), y) for _, y, b in got]
    classes = (counts.get(0, 0), counts.get(1, 0))
    machine = train([r for i, r in enumerate(data) if i % CALIBRATE != CALIBRATE - 1], classes)
    machine.scale = calibrate(machine, data[CALIBRATE - 1 :: CALIBRATE], classes)
    return machine


RESULT = T.StructType([T.StructField("score", T.DoubleType())])


class Scorer:
    """Scores texts; remembers which rows of the model a word stands for."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.known: dict[str, tuple[int, ...]] = {}

    def rows(self, word: str) -> tuple[int, ...]:
        place = self.machine.place
        return tuple(place[b] for b in buckets(word) if b in place)

    def score(self, text: str | None) -> float:
        known, at = self.known, set()
        for word in words(text):
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = self.rows(word)
            if found:
                at.update(found)
        return self.machine.score(np.fromiter(at, np.int64, len(at)))


def score(df: DataFrame, text_col: str, machine: Machine, name: str = "toxicity", carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name``: ``score``, the probability from the whole text.

    A null or empty text gets the score of no terms. Only the text is used, whole whatever its length. Repeated rows stay and
    get the same score; an empty table gives an empty result; a column called ``name`` gives way.
    """
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def start():
        scorer = Scorer(shared.value)
        return lambda texts: struct_array(score=pa.array([scorer.score(t) for t in texts], pa.float64()))

    return annotate(df, [col(text_col).cast("string")], name, RESULT, start, carry)
