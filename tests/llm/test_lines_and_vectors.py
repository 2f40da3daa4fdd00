"""Line dedup, hard negatives and centroid clustering against plain versions, with odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import centroids, linededup, negatives

NAMES = ["lines", "centroid", "row", "id", "label", "v", "__row", "a.b", "text x", "cell"]


def with_names(frame):
    return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(NAMES) if c not in frame.columns])


# ---- lines -------------------------------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_lines(texts: list[str | None], min_docs: int, min_chars: int, keep_first: bool) -> list[tuple[int, int, str]]:
    keys = [[line.strip(SPACE).translate(UPPER) for line in (t or "").split("\n")] for t in texts]
    docs = Counter(k for own in keys for k in set(own) if len(k) >= min_chars)
    out, seen = [], set()
    for t, own in zip(texts, keys):
        left = []
        for line, key in zip((t or "").split("\n"), own):
            if docs[key] < min_docs or (keep_first and key not in seen):
                left.append(line)
            seen.add(key)
        out.append((len(own), len(own) - len(left), "\n".join(left)))
    return out


ODD_TEXTS = [None, "", "\n", " \t\n\r", "Ärger\nÄRGER\närger", "  Same line \nown 1", "same LINE\nsame line\n\nown 2", "\x0bSame Line\x0c", "Same line\xa0", "é", "É", "日本\n日本", "日本"]


def line_table(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, body string").coalesce(1)
    return with_names(frame)


@pytest.mark.parametrize("min_docs, min_chars, keep_first", [(2, 1, True), (2, 1, False), (3, 2, False), (2, 3, True)])
def test_lines_of_odd_texts(spark, min_docs, min_chars, keep_first):
    texts = ODD_TEXTS + ["Same line"] * 3 + ["x" * 100_000 + "\nSame line"] * 2
    made = linededup.dedup(line_table(spark, texts), "body", min_docs, min_chars, keep_first)
    assert [c for c in made.columns if c != "lines"] == [c for c in line_table(spark, []).columns if c != "lines"]
    got = {r["n"]: tuple(r["lines"]) for r in made.collect()}
    assert [got[i] for i in range(len(texts))] == plain_lines(texts, min_docs, min_chars, keep_first)


@pytest.mark.parametrize("filter_bits", [1 << 20, 1 << 22])
def test_lines_of_many_documents(spark, filter_bits):
    """A third of the documents share a line; also a filter with one segment, in many tasks."""
    rng = random.Random(5)
    texts = ["\n".join(([f"Shared {rng.randrange(40)}"] if i % 3 else ["hot line"]) + [f"line {rng.randrange(9_000)}" for _ in range(12)]) for i in range(3_000)]
    made = linededup.dedup(line_table(spark, texts).repartition(16), "body", 10, 1, False, filter_bits)
    assert {r["n"]: tuple(r["lines"]) for r in made.collect()} == dict(enumerate(plain_lines(texts, 10, 1, False)))


def test_only_suspects_are_shuffled(spark):
    texts = [f"own line {i}\nshared" for i in range(5_000)]
    stored = line_table(spark, texts).select(F.col("n").alias("__row"), F.col("body")).repartition(8)
    keyed = spark.createDataFrame([(r["__row"], (linededup.digests(r["body"].encode()),)) for r in stored.collect()], "__row long, __keys struct<digests: binary>")
    bits = spark.sparkContext.broadcast([(r["segment"], bytes(r["bits"])) for r in linededup._merged(linededup._sent_places(keyed, 1 << 22)).collect()])
    lines = [r["line"] for r in linededup._suspects(keyed, bits, "test", 1 << 22).collect()]
    assert lines.count(1) == 5_000 and lines.count(0) < 50


def test_no_lines(spark):
    empty = linededup.dedup(line_table(spark, []), "body")
    assert empty.count() == 0 and "lines" in empty.columns


# ---- vectors -----------------------------------------------------------------------------------------------

DIMS = 6


def vectors(seed: int, n: int, grain: float = 0.05) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(7, DIMS))
    x = middles[rng.integers(0, 7, n)] + 0.4 * rng.normal(size=(n, DIMS))
    # A coarse grain makes ties.
    return (np.round(x / grain) * grain).tolist()


def odd_vectors(n: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, v, rng.randrange(4)) for i, v in enumerate(vectors(seed, n, 0.25))]
    rows += [rows[0], rows[0], rows[7]] + [(n + i, rows[5][1], i % 3) for i in range(n // 3)]
    rows += [(None, vectors(9, 1)[0], 1), (-100, vectors(8, 1)[0], 1), (2 * n, None, 1), (2 * n + 1, vectors(1, 1)[0], None)]
    rows += [(2 * n + 2, [0.0] * (DIMS - 1), 1), (2 * n + 3, [], 1), (2 * n + 4, [math.nan] * DIMS, 1), (2 * n + 5, [math.inf] + [0.0] * (DIMS - 1), 1), (2 * n + 6, [None] + [0.0] * (DIMS - 1), 1)]
    return rows


def vector_table(spark, rows):
    return with_names(spark.createDataFrame(rows, "vec_id long, embedding array<double>, kind int")).repartition(5)


def scaled(v):
    if v is None or len(v) != DIMS or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def plain_clusters(rows, k, rounds):
    kept = [(i, scaled(v)) for i, v, *_ in rows if scaled(v)]
    middle = [v for _, v in sorted((str(i), v) for i, v in kept if i is not None)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        at = [min(range(len(middle)), key=lambda c: (far(v, middle[c]), c)) for _, v in kept]
        if r < rounds:
            groups = [[v for (_, v), a in zip(kept, at) if a == c] for c in range(len(middle))]
            middle = [[sum(x) // len(g) for x in zip(*g)] if g else m for g, m in zip(groups, middle)]
    d = [far(v, middle[a]) for (_, v), a in zip(kept, at)]
    sums = Counter()
    for a, x in zip(at, d):
        sums[a] += x
    return sorted((str(i), a, x, sums[a], sum(d), tuple(middle[a])) for (i, _), a, x in zip(kept, at, d))


@pytest.mark.parametrize("k, rounds, n", [(5, 4, 200), (1, 2, 30), (400, 1, 60), (9, 0, 100)])
def test_clusters(spark, k, rounds, n):
    rows = odd_vectors(n)
    made = centroids.cluster(vector_table(spark, rows), "embedding", F.col("vec_id").cast("string"), k, rounds, DIMS)
    assert [c for c in made.columns if c != "centroid"] == [c for c in vector_table(spark, rows[:1]).columns if c != "centroid"]
    got = sorted((str(r["vec_id"]), *tuple(r["centroid"])[:4], tuple(r["centroid"]["components"])) for r in made.collect())
    assert got == plain_clusters(rows, k, rounds)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], 1)]):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kind int")
        assert centroids.cluster(table, "embedding", F.col("vec_id").cast("string"), 3, 2, DIMS).count() == 0
        made = negatives.hard_negatives(table, "vec_id", "embedding", F.col("kind"), F.col("vec_id") % 10 == 0, dims=DIMS)
        assert made.count() == 0 and made.columns[0] == "anchor_id"


def test_too_large_components(spark):
    table = spark.createDataFrame([(1, [1e9] * DIMS)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="beyond"):
        centroids.cluster(table, "embedding", F.col("vec_id").cast("string"), 3, 2, DIMS)


@pytest.mark.parametrize("seed", range(6))
def test_loosening_holds_and_is_tighter(seed):
    rng = np.random.default_rng(seed)
    k, dims = 8, 16
    old = rng.normal(size=(k, dims)) * 100
    new = old + rng.normal(size=(k, dims)) * rng.choice([0, 1, 20], size=(k, 1))
    radius = rng.uniform(0, 120, k)
    bound = centroids.loosening(old, new, radius)
    for i in range(k):
        x = rng.normal(size=(4_000, dims))
        x = old[i] + radius[i] * x / np.sqrt((x**2).sum(axis=1))[:, None] * rng.uniform(0, 1, (4_000, 1)) ** 0.1
        # The worst points lie towards the moved centroids.
        towards = np.delete(new, i, axis=0) - old[i]
        x = np.r_[x, old[i] + radius[i] * towards / np.sqrt((towards**2).sum(axis=1))[:, None]]
        shrunk = np.sqrt(((x[:, None] - old) ** 2).sum(axis=2)) - np.sqrt(((x[:, None] - new) ** 2).sum(axis=2))
        others = np.arange(k) != i
        assert shrunk[:, others].max() <= bound[i] + 1e-9
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))[others].max()
        assert bound[i] <= drift + 1e-9
    assert (bound < 0.95 * np.sqrt(((new - old) ** 2).sum(axis=1)).max()).any()


def test_bounds_spare_vectors():
    """On separate clusters most vectors keep their cluster by their bounds, without a scan of all centroids."""
    x = np.array(vectors(4, 4_000)) * 256 // 1
    kind, scans = np.float64, []
    c = x[[1, 50, 100, 200, 300, 400, 500]]
    still = np.zeros(7)
    state = centroids.assign(x, centroids.Round(c, still, still, centroids.half_ways(c), kind), None, None, None)
    for _ in range(6):
        moved = np.array([x[state[0] == i].mean(axis=0) // 1 if (state[0] == i).any() else c[i] for i in range(7)])
        radius = np.array([state[1][state[0] == i].max(initial=0) for i in range(7)])
        now = centroids.Round(moved, np.sqrt(((moved - c) ** 2).sum(axis=1)), centroids.loosening(c, moved, radius), centroids.half_ways(moved), kind)
        upper, lower = state[1] + now.drift[state[0]], state[2] - now.loosened[state[0]]
        scans.append((upper >= np.maximum(lower, now.half[state[0]])).mean())
        c, state = moved, centroids.assign(x, now, *state)
        assert (state[0] == centroids.squared(x, c).argmin(axis=1)).all()
    assert scans[-1] < 0.5


def plain_negatives(rows, positives, count, low, high, anchor):
    kept = [(n, i, scaled(v), k) for n, (i, v, k) in enumerate(rows) if scaled(v) and k is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda f: (-f[0], f[1] is None, f[1] or 0)
    out = []
    for n, i, v, k in kept:
        if i is None or not anchor(i):
            continue
        scores = [(dot(v, w), j, l, m) for m, j, w, l in kept if m != n]
        same = sorted([s for s in scores if s[2] == k], key=order)[:positives]
        other = sorted([s for s in scores if s[2] != k], key=order)
        for s in same:
            hard = [o for o in other if low * s[0] <= 100 * o[0] <= high * s[0]][:count]
            out += [(str(i), str(s[1]), r, str(o[1]), s[0], o[0]) for r, o in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("n, positives, count, low, high", [(300, 5, 10, 30, 90), (300, 2, 400, -50, 100), (40, 5, 3, 90, 91)])
def test_negatives(spark, n, positives, count, low, high):
    rows = odd_vectors(n)
    made = negatives.hard_negatives(vector_table(spark, rows), "vec_id", "embedding", F.col("kind"), F.col("vec_id") % 10 == 0, positives, count, low, high, dims=DIMS, piece=64)
    got = sorted((str(r.anchor_id), str(r.positive_id), r["rank"], str(r.negative_id), r.positive_score, r.negative_score) for r in made.collect())
    assert got == plain_negatives(rows, positives, count, low, high, lambda i: i % 10 == 0)


def test_cells_come_by_bound_and_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2_000, 8)) * 50 // 1
    books = tuple(negatives.codebook(h, 6) for h in (x[:, :4], x[:, 4:]))
    codes = [negatives.nearest(h, b) for h, b in zip((x[:, :4], x[:, 4:]), books)]
    radii = tuple(np.array([np.sqrt(((h[c == i] - b[i]) ** 2).sum(axis=1)).max(initial=0) for i in range(6)]) for h, b, c in zip((x[:, :4], x[:, 4:]), books, codes))
    counts = np.zeros((6, 6), int)
    np.add.at(counts, tuple(codes), 1)
    index = negatives.Index(books, radii, counts, np.float64)
    for q in x[:20]:
        seen = list(index.visits(q))
        assert sorted(c for c, _, _ in seen) == np.flatnonzero(counts.ravel()).tolist()
        assert all(a[2] >= b[2] for a, b in zip(seen, seen[1:]))
        for cell, low, high in seen:
            scores = x[codes[0] * 6 + codes[1] == cell] @ q
            assert low <= scores.min() and scores.max() <= high


def test_search_stops_before_the_last_cell(spark, monkeypatch):
    """On separate clusters windows are certified early, and what is left unread cannot matter."""
    begun = []
    real = negatives._visit
    monkeypatch.setattr(negatives, "_visit", lambda q, sent, begin, end, k, blocks: begun.append((begin, q.count())) or real(q, sent, begin, end, k, blocks))
    rng = np.random.default_rng(1)
    rows = [(i, (np.eye(DIMS)[i % DIMS] * 10 + rng.normal(size=DIMS) * 0.05).tolist(), i % 2) for i in range(400)]
    made = negatives.hard_negatives(vector_table(spark, rows), "vec_id", "embedding", F.col("kind"), F.col("vec_id") % 50 == 0, low=95, high=100, dims=DIMS)
    got = sorted((str(r.anchor_id), str(r.positive_id), r["rank"], str(r.negative_id), r.positive_score, r.negative_score) for r in made.collect())
    assert got == plain_negatives(rows, 5, 10, 95, 100, lambda i: i % 50 == 0)
    assert begun[0] == (0, 8) and max(b for b, _ in begun) < 16
