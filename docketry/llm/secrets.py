"""Secret scans: patterns find candidates, a character convolutional network judges every one of them.

Three base patterns always report what they match. Further candidates are tokens of 16 or more characters with
a letter and a digit, unless base matches cover all of the token. The network reads each candidate whole, with ``CONTEXT`` characters on both sides: characters
are embedded, convolved, and pooled by maximum and mean over the candidate and over its context; two dense layers
give a score. It is trained on labelled findings: the corpus's own base findings and plain words (a bounded
sample of each), and findings of known formats generated by rule, so that it also learns where a corpus has none.
The scores are calibrated on findings kept back. The threshold is set on kept-back secrets of the kind that it
decides, tokens that no base pattern reports: it is the highest at which a recall under ``RECALL`` would leave so few
of them unreported only one time in twenty. Candidates at or above it are added as kind ``cnn``.

Candidates are found in one pass over the texts and written with their context; training and judging read only
that small table.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import annotate, col, struct_array
from docketry.llm.common import written as stored
from docketry.sources.scratch import mark, release

CONTEXT = 24
RECALL = 0.98
SAMPLE = 1500
# Characters of a training row, context included, at most.
LONGEST = 1000
KINDS = ("assign", "access", "hex", "cnn")

# Fixed patterns of the base findings.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
# A text without any of these has no assignment.
_NAMES = ("passw", "secret", "token", "api")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The matches of the base patterns as (kind, start, end), by start, then kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(n in lower for n in _NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def other_candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Long mixed tokens that the base spans do not cover; one that they cover in part is a candidate as a whole."""
    merged: list[list[int]] = []
    for _, x, y in base:
        if merged and x <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], y)
        else:
            merged.append([x, y])
    out, k = [], 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        token = m[0]
        while k < len(merged) and merged[k][1] < b:
            k += 1
        covered = k < len(merged) and merged[k][0] <= a
        if not covered and any(c.isdigit() for c in token) and any(c.isalpha() for c in token):
            out.append((a, b))
    return out


# ---- network -----------------------------------------------------------------------------------------------

_ALPHABET = string.ascii_letters + string.digits + "+/_.=-:\"' @,;&?%#\n"
OTHER, PAD = len(_ALPHABET) + 1, 0
_CODE = np.full(128, OTHER, np.int64)
for _i, _c in enumerate(_ALPHABET):
    _CODE[ord(_c)] = _i + 1
EMBED, WIDTH, FILTERS, HIDDEN = 8, 5, 24, 16
# Characters convolved at a time.
_ROWS = 1 << 14


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], OTHER)


class Network:
    """Embedding, convolution, pooling inside and outside the candidate, two dense layers."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.3, (OTHER + 1, EMBED)),
            "k": r.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
            "kb": np.zeros(FILTERS),
            "h": r.normal(0, (2 / (4 * FILTERS)) ** 0.5, (4 * FILTERS, HIDDEN)),
            "hb": np.zeros(HIDDEN),
            "o": r.normal(0, 0.2, HIDDEN),
            "ob": np.zeros(1),
        }

    def convolved(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of embedded characters, one per character, and what the filters make of them."""
        half = WIDTH // 2
        padded = np.concatenate([np.zeros(half, np.int64), c, np.zeros(half, np.int64)])
        windows = self.p["e"][np.lib.stride_tricks.sliding_window_view(padded, WIDTH)].reshape(len(c), -1)
        return windows, np.maximum(windows @ self.p["k"] + self.p["kb"], 0)

    def pooled(self, c: np.ndarray, start: int, end: int) -> tuple[np.ndarray, tuple]:
        windows, made = self.convolved(c)
        inside = np.zeros(len(c), bool)
        inside[start:end] = True
        parts, marks = [], []
        for mask in (inside, ~inside):
            where = np.flatnonzero(mask)
            if len(where):
                top = where[made[where].argmax(axis=0)]
                parts += [made[top, np.arange(FILTERS)], made[where].mean(axis=0)]
            else:
                top = None
                parts += [np.zeros(FILTERS), np.zeros(FILTERS)]
            marks.append((where, top))
        return np.concatenate(parts), (windows, made, marks)

    def logit(self, text: str, start: int, end: int) -> float:
        """The score of ``text[start:end]`` in its context; long candidates are convolved piece by piece."""
        c = codes(text)
        if len(c) <= _ROWS:
            x = self.pooled(c, start, end)[0]
        else:
            tops, sums = np.zeros((2, FILTERS)), np.zeros((2, FILTERS))
            half = WIDTH // 2
            for at in range(0, len(c), _ROWS):
                lo, hi = max(0, at - half), min(len(c), at + _ROWS + half)
                made = self.convolved(c[lo:hi])[1][at - lo : at - lo + min(_ROWS, len(c) - at)]
                place = np.arange(at, at + len(made))
                inside = (place >= start) & (place < end)
                for k, mask in enumerate((inside, ~inside)):
                    if mask.any():
                        tops[k] = np.maximum(tops[k], made[mask].max(axis=0))
                        sums[k] += made[mask].sum(axis=0)
            n = (max(1, end - start), max(1, len(c) - (end - start)))
            x = np.concatenate([tops[0], sums[0] / n[0], tops[1], sums[1] / n[1]])
        return float(np.maximum(x @ self.p["h"] + self.p["hb"], 0) @ self.p["o"] + self.p["ob"][0])

    def gradient(self, c: np.ndarray, start: int, end: int, label: int, g: dict[str, np.ndarray]) -> None:
        x, (windows, made, marks) = self.pooled(c, start, end)
        hidden = np.maximum(x @ self.p["h"] + self.p["hb"], 0)
        d = 1 / (1 + np.exp(-np.clip(hidden @ self.p["o"] + self.p["ob"][0], -30, 30))) - label
        g["o"] += d * hidden
        g["ob"] += d
        dh = d * self.p["o"] * (hidden > 0)
        g["h"] += np.outer(x, dh)
        g["hb"] += dh
        dx = self.p["h"] @ dh
        dm = np.zeros_like(made)
        for k, (where, top) in enumerate(marks):
            if top is not None:
                dm[top, np.arange(FILTERS)] += dx[2 * k * FILTERS : (2 * k + 1) * FILTERS]
                dm[where] += dx[(2 * k + 1) * FILTERS : (2 * k + 2) * FILTERS] / len(where)
        dm *= made > 0
        g["k"] += windows.T @ dm
        g["kb"] += dm.sum(axis=0)
        dw = (dm @ self.p["k"].T).reshape(-1, EMBED)
        half = WIDTH // 2
        padded = np.concatenate([np.zeros(half, np.int64), c, np.zeros(half, np.int64)])
        np.add.at(g["e"], np.lib.stride_tricks.sliding_window_view(padded, WIDTH).ravel(), dw)

    def train(self, rows: list[tuple[str, int, int, int]], epochs: int = 6, batch: int = 32, rate: float = 0.004) -> None:
        """Adam over labelled ``(text, start, end, label)`` rows, in a seeded order."""
        random, data = np.random.default_rng(9), [(codes(t), a, b, y) for t, a, b, y in rows]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(data))
            for at in range(0, len(order), batch):
                g = {k: np.zeros_like(v) for k, v in self.p.items()}
                some = order[at : at + batch]
                for i in some:
                    self.gradient(*data[i], g)
                step += 1
                for k in self.p:
                    d = g[k] / len(some)
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.999 * s[k] + 0.001 * d * d
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)


@dataclass
class Judge:
    """A trained network with its calibration and threshold."""

    network: Network
    slope: float
    offset: float
    threshold: float

    def score(self, text: str, start: int, end: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.network.logit(text, start, end) + self.offset, -30, 30))))


#: The formats of generated secrets, by name.
FORMATS = ("base62", "hex", "base64", "access", "prefixed", "dotted", "pair", "assigned")


def generated(n: int, contexts: list[str], seed: int = 3, formats: tuple[str, ...] = FORMATS) -> list[tuple[str, int, int, int]]:
    """``n`` secrets of some formats and ``n`` harmless tokens, set between given contexts."""
    r = np.random.default_rng(seed)
    pick = lambda alphabet, lo, hi: "".join(r.choice(list(alphabet), int(r.integers(lo, hi + 1))))
    word = lambda: pick(string.ascii_lowercase, 3, 9)
    base62, hexes, base64 = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    makers_of = {
        "base62": lambda: pick(base62, 20, 64),
        "hex": lambda: pick(hexes, 24, 64),
        "base64": lambda: pick(base64, 24, 88) + "=" * int(r.integers(0, 3)),
        "access": lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16),
        "prefixed": lambda: pick(string.ascii_lowercase, 2, 4) + "_" + pick(base62, 24, 40),
        "dotted": lambda: pick(base62, 12, 24) + "." + pick(base62, 12, 40) + "." + pick(base62, 12, 40),
        "pair": lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16) + str(r.choice(list("/=._-"))) + pick(base64, 40, 40),
        "assigned": lambda: str(r.choice(["password", "token", "secret", "api_key"])) + str(r.choice(["=", ": ", ' = "'])) + pick(base62, 8, 40),
    }
    secrets = [makers_of[f] for f in formats]
    harmless = [
        lambda: "-".join(word() for _ in range(int(r.integers(3, 6)))) + "-" + pick(string.digits, 1, 4),
        lambda: "/".join(word() for _ in range(int(r.integers(3, 6)))) + "/" + pick(string.digits, 1, 5) + ".html",
        lambda: "www." + word() + word() + pick(string.digits, 1, 2) + ".example.com",
        lambda: word() + "." + word() + pick(string.digits, 1, 4) + ".example.org",
        lambda: f"{r.integers(1990, 2030)}-{r.integers(10, 12)}-{r.integers(10, 28)}T{r.integers(10, 23)}.{r.integers(10, 59)}.{r.integers(10, 59)}",
        lambda: word() + "_" + word() + "_" + word() + "_v" + pick(string.digits, 1, 3) + ".tar.gz",
        lambda: word() + word() + word() + pick(string.digits, 1, 2),
        lambda: pick(string.digits, 1, 3) + ".".join(pick(string.digits, 1, 3) for _ in range(5)) + "px",
        lambda: "=" * int(r.integers(8, 20)) + word() + "1" + "=" * int(r.integers(8, 20)),
        lambda: word() + " " + word() + " " + word(),
    ]
    out = []
    for label, makers in ((1, secrets), (0, harmless)):
        for i in range(n):
            token = makers[i % len(makers)]()
            around = contexts[int(r.integers(0, len(contexts)))] if contexts else f"{word()} {word()} {word()}"
            before, after = around[:CONTEXT].rpartition(" ")[0], around[CONTEXT:].partition(" ")[2][:CONTEXT]
            text = f"{before} {token} {after}"
            out.append((text, len(before) + 1, len(before) + 1 + len(token), label))
    return out


def decided(text: str, start: int, end: int) -> bool:
    """Whether the threshold decides a finding: base spans stay whatever it is."""
    return (start, end) in other_candidates(text, base_spans(text))


def allowed_misses(n: int, recall: float) -> int:
    """How many of ``n`` secrets may be missed so that a recall below ``recall`` is ruled out at one in twenty."""
    chance = total = recall**n
    k = 0
    while k < n and total <= 0.05:
        chance *= (n - k) / (k + 1) * (1 - recall) / recall
        k += 1
        total += chance
    return max(0, k - 1)


def judge(findings: list[tuple[str, int, int, int]], recall: float = RECALL) -> Judge:
    """Train on four fifths of the labelled findings; calibrate and choose the threshold on the rest."""
    network = Network()
    network.train([f for i, f in enumerate(findings) if i % 5])
    kept = findings[::5]
    logits = np.array([network.logit(t, a, b) for t, a, b, _ in kept])
    y = np.array([label for *_, label in kept], float)
    x, theta, ridge = np.stack([logits, np.ones_like(logits)], axis=1), np.array([1.0, 0.0]), np.diag([1.0, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        theta = theta - np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ (theta - [1.0, 0.0]))
    slope, offset = (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)
    own = np.array([bool(label) and decided(t, a, b) for t, a, b, label in kept], bool)
    scores = np.sort(1 / (1 + np.exp(-np.clip(slope * logits[own] + offset, -30, 30))))
    # With none kept back nothing is known, so every candidate is reported.
    return Judge(network, slope, offset, float(scores[allowed_misses(len(scores), recall)]) if len(scores) else 0.0)


# ---- Spark -------------------------------------------------------------------------------------------------

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
CANDIDATE = T.StructType([*SPAN.fields, T.StructField("at", T.LongType()), T.StructField("text", T.StringType())])
FOUND = T.StructType([T.StructField("candidates", T.ArrayType(CANDIDATE)), T.StructField("plain", T.StringType())])
_CANDIDATE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("at", pa.int64()), ("text", pa.string())]))
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(texts: list[bytes | None]) -> pa.StructArray:
    rows, plain = [], []
    for raw in texts:
        text = (raw or b"").decode("utf-8", "replace")
        base = base_spans(text)
        every = base + [("cnn", a, b) for a, b in other_candidates(text, base)]
        rows.append([{"kind": k, "start": a, "end": b, "at": max(0, a - CONTEXT), "text": text[max(0, a - CONTEXT) : b + CONTEXT]} for k, a, b in every])
        # A few words from the middle, for contexts and harmless findings.
        middle = len(text) // 2
        plain.append(text[middle : middle + 2 * CONTEXT])
    return struct_array(candidates=pa.array(rows, _CANDIDATE), plain=pa.array(plain, pa.string()))


def train(found: DataFrame, key: Column, sample: int = SAMPLE, longest: int = LONGEST) -> Judge:
    """A judge from the base findings of ``found`` and generated ones; at most ``sample`` rows of either sort.

    Base findings of more than ``longest`` characters with their context are no training rows, which bounds what the driver
    gets to ``sample * longest``; they are found, judged and reported like all others. The rows are those with the smallest
    hash of ``key``, then by place and text, so the choice depends neither on partitions nor on the order of repeated ids.
    """
    order = F.xxhash64(key)
    hits = found.select(order.alias("h"), F.explode("__found.candidates").alias("c")).filter("c.kind <> 'cnn'")
    some = hits.select("h", "c.start", "c.end", "c.at", F.length("c.text").alias("n"), F.col("c.text").alias("text")).filter(F.col("n") <= longest)
    positive = [(r["text"], r["start"] - r["at"], r["end"] - r["at"], 1) for r in some.orderBy("h", "start", "end", "text").limit(sample).collect()]
    plain = [r["plain"] for r in found.select(order.alias("h"), "__found.plain").filter("size(__found.candidates) = 0 AND length(__found.plain) >= 40").orderBy("h", "plain").limit(sample).collect()]
    negative = []
    for text in plain[: sample // 2]:
        token = max(re.finditer(r"\S+", text), key=lambda m: len(m[0]), default=None)
        if token:
            negative.append((text, *token.span(), 0))
    rows = positive + negative + generated(sample, plain)
    order_of = np.random.default_rng(1).permutation(len(rows))
    return judge([rows[i] for i in order_of])


def scan(
    df: DataFrame, id_col: str, text_col: str, name: str = "secrets", carry: list[str] | None = None, sample: int = SAMPLE, redacted: bool = False,
    longest: int = LONGEST,
) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name``: ``base`` and ``spans``, arrays of kind, start, end.

    With ``redacted``, which needs the text among the columns kept, ``text`` is the text with its spans replaced
    by marks; it is null where there is nothing to replace.

    Positions are code points of the text, the end exclusive; spans are ordered by start, then kind. A null or
    empty text has none. ``id_col`` only chooses training rows, of at most ``longest`` characters. Repeated rows stay and are
    judged alike; spans that start together come in the order of ``KINDS``. Texts and candidates of any length are taken
    whole. An empty table gives an empty result; a column called ``name`` gives way.
    """
    begun = mark()
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    text = [] if text_col in kept else [col(text_col)]
    source = df.select(*[col(c) for c in kept], *text, col(id_col).alias("__key"))
    found, path = stored(annotate(source, [text_col], "__found", FOUND, lambda: _find, [*kept, "__key"]), "secrets")
    release(df.sparkSession, begun, keep=[path])
    shared = df.sparkSession.sparkContext.broadcast(train(found, F.col("__key").cast("string"), sample, longest))
    spans = T.ArrayType(SPAN)

    def start():
        own: Judge = shared.value

        def score(rows: list[list[dict]], texts: list[bytes | None]) -> pa.StructArray:
            base, every, clean = [], [], []
            for row, text in zip(rows, texts):
                fixed = [{k: c[k] for k in ("kind", "start", "end")} for c in row if c["kind"] != "cnn"]
                judged = [(c, own.score(c["text"], c["start"] - c["at"], c["end"] - c["at"])) for c in row]
                more = [{k: c[k] for k in ("kind", "start", "end")} for c, s in judged if c["kind"] == "cnn" and s >= own.threshold]
                base.append(fixed)
                every.append(sorted(fixed + more, key=lambda c: (c["start"], KINDS.index(c["kind"]))))
                if redacted:
                    found_here = [(c["kind"], c["start"], c["end"]) for c in every[-1]]
                    clean.append(redact(text.decode("utf-8", "replace"), found_here) if found_here else None)
            more = {"text": pa.array(clean, pa.string())} if redacted else {}
            return struct_array(base=pa.array(base, _SPAN), spans=pa.array(every, _SPAN), **more)

        return score

    kind = T.StructType([T.StructField("base", spans), T.StructField("spans", spans), *([T.StructField("text", T.StringType())] if redacted else [])])
    text = text_col if redacted else F.lit(None).cast("binary")
    return annotate(found, [F.col("__found.candidates"), text], name, kind, start, kept)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with its spans, overlapping ones merged, replaced by a mark of the first one's kind."""
    out, at, merged = [], 0, []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
