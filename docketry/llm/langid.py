"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, and everything but letters becomes a space. N-grams of one to three characters are hashed
into ``2 ** BITS`` buckets. A bucket's weight in a text is ``1 + ln(count)`` times its inverse document frequency,
and the weights have length 1. The document frequencies are counted over all learnable rows. The regression is
trained with follow-the-regularised-leader and an elastic-net penalty on about ``per_language`` rows of each
language, those whose hashed id lies below a share of the range; every ``CALIBRATE``-th of them is kept back to
choose the temperature that makes the scores probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import SLICE, annotate, col, place, share_of, struct_array

BITS = 15
PER_LANGUAGE = 600
CALIBRATE = 5
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_MIX = np.uint32(0x9E3779B1)
_NEXT = np.uint32(16777619)
# Characters hashed at a time.
_RUN = 1 << 20


def letters(text: str | None) -> str:
    """The text's letters in lower case with single spaces between and around; empty without a letter."""
    plain = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {plain} " if any(map(str.isalpha, plain)) else ""


def gram_counts(plain: str) -> np.ndarray:
    """Occurrences of hashed 1-, 2- and 3-grams by bucket."""
    counts = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(plain), _RUN):
        c = np.frombuffer(plain[at : at + _RUN + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        # The last run ends with the text; the others leave their overlap to the next.
        own = min(_RUN, len(plain) - at)
        code = c
        for n in (1, 2, 3):
            if n > 1:
                code = code[:-1] * _NEXT + c[n - 1 :] if len(code) > 1 else code[:0]
            mixed = ((code[:own] + np.uint32(n)) * _MIX) >> np.uint32(32 - BITS)
            counts += np.bincount(mixed, minlength=1 << BITS)
    return counts


def sparse(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    where = np.flatnonzero(counts)
    return where.astype(np.int32), (1 + np.log(counts[where])).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, where: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x = tf * self.idf[where]
        size = np.sqrt(x @ x)
        return (x @ self.weights[where]) / (size or 1.0) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its calibrated probability; the unknown one where there is no letter."""
        plain = letters(text)
        if not plain or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*sparse(gram_counts(plain))) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, idf: np.ndarray, alpha=0.5, beta=1.0, l1=0.02, l2=0.1, epochs=4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader; ``rows`` are buckets, term weights and class."""
    d = len(idf) + 1
    z, n = np.zeros((d, classes)), np.zeros((d, classes))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            where, tf, wanted = rows[r]
            x = tf * idf[where]
            x = np.append(x / (np.sqrt(x @ x) or 1.0), 1.0)
            at = np.append(where, d - 1)
            w = _weights(z[at], n[at], alpha, beta, l1, l2)
            error = softmax(x @ w)
            error[wanted] -= 1
            g = np.outer(x, error)
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = _weights(z, n, alpha, beta, l1, l2)
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def _weights(z, n, alpha, beta, l1, l2):
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def temperature(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """The temperature with the least log loss on rows the model has not seen."""
    if not rows:
        return 1.0
    logits = np.array([model.logits(where, tf) for where, tf, _ in rows])
    wanted = np.array([c for _, _, c in rows])

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), wanted]))

    # Below a tenth the scores of separable languages would only run to 1.
    grid = np.geomspace(0.1, 10, 81)
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def document_frequency(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are; buckets are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(at, SLICE).to_pylist():
                    if plain := letters(text):
                        seen += gram_counts(plain) > 0
                        total += 1
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *where.tolist()], pa.int64()), pa.array([total, *seen[where].tolist()], pa.int64())], names=["bucket", "n"])

    sums = texts.select(col(text_col).cast("string").alias("t")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen, total = np.zeros(1 << BITS, np.int64), 0
    for bucket, n in sums.collect():
        if bucket < 0:
            total = n
        else:
            seen[bucket] = n
    return seen, total


def fit(df: DataFrame, text_col: str, lang_col: str, id_col: str, learnable: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Train on the learnable rows with a language; document frequencies count all of them.

    What reaches the driver: a count per language and per bucket, and the grams of the sample. Rows without an id
    are not learnable where ``learnable`` asks for it; repeated rows of an id are one row of the sample.
    """
    rows = df.filter(learnable & col(lang_col).isNotNull()).select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"), col(id_col).alias("id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    seen, total = document_frequency(rows, "text")
    idf = np.log((1 + total) / (1 + seen)) + 1

    def start():
        def score(texts: list[str | None]) -> pa.StructArray:
            made = [sparse(gram_counts(plain)) if (plain := letters(t)) else None for t in texts]
            return struct_array(packed=pa.array([b"" if m is None else m[0].tobytes() + m[1].tobytes() for m in made], pa.binary()))

        return score

    some = rows.filter(place(F.col("id")) < share_of(F.col("lang"), counts, per_language))
    grams = annotate(some, [F.col("text")], "grams", T.StructType([T.StructField("packed", T.BinaryType())]), start, ["lang", "id"])
    # One row of each id, so that repeated rows cannot widen the sample.
    got = sorted((r["lang"], bytes(r["packed"])) for r in grams.groupBy("lang", "id").agg(F.min("grams.packed").alias("packed")).collect())
    got = [(lang, np.frombuffer(b, np.int32, len(b) // 8), np.frombuffer(b, np.float32, offset=len(b) // 2)) for lang, b in got if b]
    languages = sorted({lang for lang, _, _ in got})
    code = {lang: i for i, lang in enumerate(languages)}
    data = [(where, tf, code[lang]) for lang, where, tf in got]
    kept_back = data[CALIBRATE - 1 :: CALIBRATE]
    learn = [r for i, r in enumerate(data) if i % CALIBRATE != CALIBRATE - 1]
    if not languages:
        return Model([], idf, np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    weights, bias = train(learn, len(languages), idf)
    model = Model(languages, idf.astype(np.float32), weights, bias)
    model.temperature = temperature(model, kept_back)
    return model


RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(df: DataFrame, text_col: str, model: Model, name: str = "language", carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name``: ``lang`` and ``score`` (0 to 1) of the whole text.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing could be
    learnt. Only the text is used, whole whatever its length; of equally likely languages the first learnt one is taken. Repeated rows
    stay and get the same answer; an empty table gives an empty result; a column called ``name`` gives way.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def score(texts: list[str | None]) -> pa.StructArray:
            made = [own.predict(t) for t in texts]
            return struct_array(lang=pa.array([m[0] for m in made], pa.string()), score=pa.array([m[1] for m in made], pa.float64()))

        return score

    return annotate(df, [col(text_col).cast("string")], name, RESULT, start, carry)
