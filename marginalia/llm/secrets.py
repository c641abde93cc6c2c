"""Secret scan: fixed patterns, and a character convolutional network over every other candidate.

Base findings come from three patterns. Every other run of secret-like characters (at least
``CANDIDATE`` of them, with a digit) is a candidate, and the network reads it with the
characters around it. The network is a numpy model: embedding of character classes, one
convolution, the maximum over the context before, the candidate and the context after, and a
linear unit. Its labelled findings are the base findings (positive) and the other candidates
(negative) of all documents, windows that repeat counted once. A third of them, by their digests, is held out: it
calibrates the output (slope and intercept of the log-odds) and sets the threshold, the highest one
that keeps ``RECALL`` of the held-out positives. Nothing is taken from a sample: tasks
pass over the windows they hold, ``EPOCHS`` times, and after each pass their weights are averaged.
Candidates above the threshold are added; base findings always stay.

A candidate longer than the window is read window by window, and its highest output counts.

Defined cases: a null or empty text has no findings; their digest is that of the empty string.
With fewer than ``MIN_EXAMPLES`` findings of either class nothing is added. Repeated rows are
rows of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.averaging import averaged_round
from marginalia.operators.quantiles import order_statistics
from marginalia.session import materialize

# The patterns and lengths of base findings.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ("assign", "access", "hex", "network")

CANDIDATE = 16
BEFORE, INSIDE, AFTER = 20, 48, 8
WIDTH, FILTERS, EMBED = 5, 12, 6
EPOCHS = 12
BLOCK = 4_096  # windows that a task holds at a time
MIN_EXAMPLES = 20
RECALL = 0.95
CLASSES = 72


def _code(c: int) -> int:
    """Class of a character: letters and digits one by one, other ASCII by symbol, the rest one class."""
    ch = chr(c)
    if ch.isalnum():
        return 1 + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789".index(ch)
    return 63 + (" \n\"':=+/_.-".find(ch) % 8 if ch in " \n\"':=+/_.-" else 7)


CODES = np.array([_code(c) for c in range(128)] + [CLASSES - 1], dtype=np.int64)


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, sorted by start, then kind."""
    found, low = [], text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    for run in RUN.finditer(text):
        found += [(2, m.start(), m.end()) for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda f: (f[1], f[0]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs that no base finding overlaps."""
    out = []
    for run in RUN.finditer(text):
        a, b = run.span()
        if any(c.isdigit() for c in text[a:b]) and not any(s < b and e > a for _, s, e in base):
            out.append((a, b))
    return out


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Windows of a candidate with its context, as character classes (0 pads)."""
    def codes(piece: str, size: int, right: bool = False) -> np.ndarray:
        values = CODES[np.minimum(np.array([ord(c) for c in piece], dtype=np.int64), 128)] if piece else np.zeros(0, np.int64)
        pad = np.zeros(size - len(values), np.int64)
        return np.concatenate([pad, values] if right else [values, pad])

    before = codes(text[max(0, start - BEFORE) : start], BEFORE, right=True)
    after = codes(text[end : end + AFTER], AFTER)
    cuts = range(start, end, INSIDE)
    return np.array([np.concatenate([before, codes(text[a : min(a + INSIDE, end)], INSIDE), after]) for a in cuts])


@dataclass
class Network:
    params: dict[str, np.ndarray]
    slope: float = 1.0
    intercept: float = 0.0
    threshold: float = 2.0
    recall: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        return forward(self.params, x)[0] * self.slope + self.intercept

    def probability(self, text: str, start: int, end: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.odds(encode(text, start, end)).max(), -30, 30))))


_PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, BEFORE + INSIDE + AFTER))


def forward(p: dict, x: np.ndarray):
    e = p["embed"][x]
    padded = np.pad(e, ((0, 0), (WIDTH // 2, WIDTH // 2), (0, 0)))
    columns = np.concatenate([padded[:, i : i + x.shape[1]] for i in range(WIDTH)], axis=2)
    conv = columns @ p["conv"] + p["conv_bias"]
    on = np.maximum(conv, 0)
    tops = [on[:, a:b].argmax(axis=1) + a for a, b in _PARTS]
    pooled = np.concatenate([np.take_along_axis(on, t[:, None, :], axis=1)[:, 0] for t in tops], axis=1)
    return pooled @ p["out"] + p["bias"][0], (columns, conv, tops, pooled)


def init_params(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        "embed": rng.normal(0, 0.3, (CLASSES, EMBED)), "conv": rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
        "conv_bias": np.zeros(FILTERS), "out": rng.normal(0, 0.2, 3 * FILTERS), "bias": np.zeros(1),
    }


class Descent:
    """Descent from given parameters with moments of its own, block by block."""

    def __init__(self, params: dict, positive: float, batch: int = 64, seed: int = 5):
        self.params, self.batch, self.rng, self.step = params, batch, np.random.default_rng(seed), 0
        self.weights = 0.5 / max(1 - positive, 1e-9), 0.5 / max(positive, 1e-9)
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}

    def learn(self, x: np.ndarray, y: np.ndarray) -> None:
        p, weight, order = self.params, np.where(y > 0, self.weights[1], self.weights[0]), self.rng.permutation(len(y))
        for at in range(0, len(y), self.batch):
            own = order[at : at + self.batch]
            odds, (columns, conv, tops, pooled) = forward(p, x[own])
            d = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y[own]) * weight[own] / len(own)
            g = {"out": pooled.T @ d, "bias": np.array([d.sum()])}
            d_pool = d[:, None] * p["out"][None, :]
            d_conv = np.zeros_like(conv)
            for i, t in enumerate(tops):
                np.put_along_axis(d_conv, t[:, None, :], d_pool[:, None, i * FILTERS : (i + 1) * FILTERS], axis=1)
            d_conv *= conv > 0
            flat = d_conv.reshape(-1, FILTERS)
            g["conv"], g["conv_bias"] = columns.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
            d_columns = d_conv @ p["conv"].T
            d_padded = np.zeros((len(own), x.shape[1] + WIDTH - 1, EMBED))
            for i in range(WIDTH):
                d_padded[:, i : i + x.shape[1]] += d_columns[:, :, i * EMBED : (i + 1) * EMBED]
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], x[own].ravel(), d_padded[:, WIDTH // 2 : WIDTH // 2 + x.shape[1]].reshape(-1, EMBED))
            self.step += 1
            for k in p:
                m, v = self.moments[k]
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] ** 2 - v)
                p[k] = p[k] - 0.01 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8)


def _windows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of the first two columns, ``BLOCK`` rows at a time."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield x.reshape(part.num_rows, -1), part.column(1).to_numpy(zero_copy_only=False).astype(float)


def labelled_windows(docs: DataFrame) -> DataFrame:
    """(x, y, held): windows of the findings of all documents, each once."""
    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                text = text or ""
                base = base_findings(text)
                rows = [(s, e, 1) for _, s, e in base] + [(s, e, 0) for s, e in candidates(text, base)]
                for s, e, y in rows:
                    if y:
                        m = ASSIGN.match(text, s)
                        s = m.start(2) if m and m.end() == e else s
                    key = hashlib.md5(text[max(0, s - BEFORE) : e + AFTER].encode("utf-8", "surrogatepass")).hexdigest()
                    out += [(key, x.astype(np.int8).tolist(), y) for x in encode(text, s, e)]
            yield pd.DataFrame(out, columns=["key", "x", "y"])

    found = docs.select("text").mapInPandas(label, "key string, x array<byte>, y int").distinct()
    return found.select("x", "y", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % 3 == 0).alias("held"))


def train(docs: DataFrame) -> Network | None:
    """Fit on the findings of all documents; None with too few of either kind."""
    data = materialize(labelled_windows(docs), "secret-windows")
    count = {(r.held, r.y): r["count"] for r in data.groupBy("held", "y").count().collect()}
    positive, negative = (sum(n for (_, y), n in count.items() if y == kind) for kind in (1, 0))
    if min(positive, negative) < MIN_EXAMPLES or not all(count.get((held, y)) for held in (False, True) for y in (0, 1)):
        return None
    share = count[False, 1] / (count[False, 1] + count[False, 0])

    def work(batches: Iterator[pa.RecordBatch], params: dict) -> tuple[dict, float]:
        descent, seen = Descent(params, share), 0
        for batch in batches:
            for x, y in _windows(batch):
                descent.learn(x, y)
                seen += len(y)
        return params, seen

    net, learnt = Network(init_params()), data.where(~F.col("held")).select("x", "y")
    for _ in range(EPOCHS):
        net.params = averaged_round(learnt, net.params, work)

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in _windows(batch):
                yield pa.RecordBatch.from_arrays([pa.array(forward(net.params, x)[0], pa.float64()), pa.array(y)], names=["raw", "y"])

    raw = materialize(data.where("held").select("x", "y").mapInArrow(outputs, "raw double, y double"), "secret-outputs")
    # Platt scaling with its smoothed targets: each output is a part positive and a part negative.
    up, down = (count[True, 1] + 1) / (count[True, 1] + 2), 1 / (count[True, 0] + 2)
    target = F.when(F.col("y") > 0, F.lit(up)).otherwise(F.lit(down))
    parts = raw.select(
        array_to_vector(F.array("raw")).alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("label"), target.alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - target).alias("weight")))).alias("p"),
    ).select("features", "p.label", "p.weight")
    platt = LogisticRegression(weightCol="weight", maxIter=100, tol=1e-9).fit(parts)
    net.slope, net.intercept = float(platt.coefficients[0]), float(platt.intercept)
    rank = count[True, 1] - int(np.ceil(RECALL * count[True, 1]))
    level = order_statistics(raw.where("y > 0"), "raw", [rank])[0][rank]
    net.threshold = float(1 / (1 + np.exp(-np.clip(level * net.slope + net.intercept, -30, 30))))
    net.recall = (count[True, 1] - rank) / count[True, 1]
    return net


def scan_text(text: str | None, net: Network | None) -> list[tuple[int, int, int]]:
    """All findings of a text, base ones first in kind, sorted by start, then kind."""
    text = text or ""
    found = base_findings(text)
    if net is not None:
        found += [(3, s, e) for s, e in candidates(text, found) if net.probability(text, s, e) >= net.threshold]
    return sorted(found, key=lambda f: (f[1], f[0]))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in found)


def find_secrets(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per document: counts of base findings, their digest, and all spans."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids pass as the Arrow column they came in, nulls and large ones too.
        for batch in batches:
            out = []
            for value in batch.column(1):
                found = scan_text(value.as_py(), net)
                base = [f for f in found if f[0] < 3]
                counts = [sum(f[0] == k for f in base) for k in range(3)]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]], names=names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)
