"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise sum is
taken in linear time as 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted on a bounded sample of labelled documents (``per_class``, a parameter);
every document is scored on its whole text in Arrow batches.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_sample

BUCKETS = 1 << 14
RANK = 8
MARKS = b"|!&%$#*.,;:?-\"'()<>{}[]@/\\=+_~^`"

STATS = [
    "log_chars", "log_words", "word_length", "distinct_words", "top_word", "lines_per_word", "distinct_lines", "upper", "lower", "digit", "space",
    "high_bytes", "marks", "marked_words", "repeated_runs", "meta_chars",
    *(f"mark_{chr(c)}" for c in MARKS[:12]),
]


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, values of unit length, raw statistics) of a whole text; null is empty."""
    text = text or ""
    data = text.encode()
    words = text.split()
    counts = Counter(words)
    stats = np.zeros(len(STATS))
    if words:
        n = len(words)
        lines = text.split("\n")
        hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
        marks = [hist[c] for c in MARKS]
        half = counts.most_common(1)[0][1] / n
        pairs = Counter(zip(words[::2], words[1::2], strict=False))
        stats[:16] = (
            math.log1p(len(text)), math.log1p(n), len(text) / n, len(counts) / n, half, len(lines) / n, len(set(lines)) / len(lines),
            hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum(), hist[[9, 10, 11, 12, 13, 32]].sum(),
            hist[128:].sum(), sum(marks), sum(not w[-1].isalnum() for w in words) / n, 1 - len(pairs) / max(1, len(words[1::2])), 0.0,
        )
        stats[16:] = [math.sqrt(m) for m in marks[:12]]
    stats[15] = math.log1p(max(0, n_chars if n_chars is not None else len(text)))
    sums: dict[int, float] = {}
    for word, k in counts.items():
        b = zlib.crc32(word.lower().encode()) & (BUCKETS - 1)
        sums[b] = sums.get(b, 0.0) + 1.0 + math.log(k)
    values = np.fromiter(sums.values(), float, len(sums))
    if len(values):
        values /= math.sqrt(float(values @ values))
    return np.fromiter(sums, np.int64, len(sums)), values, stats


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    fitted: bool = False

    def inputs(self, buckets: np.ndarray, values: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((stats - self.mean) / self.scale, -4, 4) / 4
        return np.concatenate([buckets, BUCKETS + np.arange(len(stats))]), np.concatenate([values, x])

    def margin(self, idx: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[idx]
        s = x @ v
        return self.bias + float(x @ self.linear[idx]) + 0.5 * float(s @ s - (x * x) @ (v * v).sum(axis=1))

    def score(self, text: str | None, n_chars: int | None) -> float:
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, self.margin(*self.inputs(*features(text, n_chars)))))))


def fit(samples: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, sizes: dict[int, int], epochs: int = 12, rate: float = 0.08, decay: float = 1e-5, seed: int = 4) -> FactorisationMachine:
    """Adagrad on the logistic loss. Classes weigh as among all labels, so scores follow the true share.

    Without rows of both classes the score is the share of ones (1/2 if there are none).
    """
    rng = np.random.default_rng(seed)
    width = BUCKETS + len(STATS)
    stats = np.array([s[2] for s in samples]) if samples else np.zeros((1, len(STATS)))
    fm = FactorisationMachine(0.0, np.zeros(width), rng.normal(0, 0.02, (width, RANK)), stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    ones = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
    fm.bias = math.log(ones / (1 - ones))
    if len(set(y.tolist())) < 2:
        fm.factors[:] = 0
        return fm
    fm.fitted = True
    weight = np.where(y == 1, ones / (y == 1).mean(), (1 - ones) / (y == 0).mean())
    weight = np.sqrt(weight / weight.min())  # between the true share and equal classes
    weight /= weight.mean()
    inputs = [fm.inputs(*s) for s in samples]
    g_w, g_v, g_b = np.full(width, 1e-4), np.full((width, RANK), 1e-4), 1e-4
    for _ in range(epochs):
        for i in rng.permutation(len(inputs)):
            idx, x = inputs[i]
            v = fm.factors[idx]
            s = x @ v
            margin = fm.bias + x @ fm.linear[idx] + 0.5 * (s @ s - (x * x) @ (v * v).sum(axis=1))
            err = weight[i] * (1 / (1 + math.exp(-min(30.0, max(-30.0, margin)))) - y[i])
            d_w = err * x + decay * fm.linear[idx]
            d_v = err * (x[:, None] * s[None, :] - v * (x * x)[:, None]) + decay * v
            g_w[idx] += d_w * d_w
            g_v[idx] += d_v * d_v
            g_b += err * err
            fm.linear[idx] -= rate * d_w / np.sqrt(g_w[idx])
            fm.factors[idx] -= rate * d_v / np.sqrt(g_v[idx])
            fm.bias -= rate * err / math.sqrt(g_b)
    return fm


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> FactorisationMachine:
    """Fit on at most ``per_class`` labelled documents of each class outside the held-out fold (crc32 mod 4 = 2)."""
    rows, sizes = training_sample(docs.select("doc_id", "text", "n_chars"), labels, "quality", 4, 2, per_class)

    def run(batches):
        for batch in batches:
            xs = [features(t.as_py(), n.as_py()) for t, n in zip(batch.column("text"), batch.column("n_chars"), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"y": batch.column("y"), "doc_id": batch.column("doc_id"), "b": [x[0].tolist() for x in xs], "v": [x[1].tolist() for x in xs], "s": [x[2].tolist() for x in xs]},
                schema=pa.schema([("y", pa.int32()), ("doc_id", pa.int64()), ("b", pa.list_(pa.int32())), ("v", pa.list_(pa.float64())), ("s", pa.list_(pa.float64()))]),
            )

    table = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_chars").cast("long").alias("n_chars"), "y").mapInArrow(run, "y int, doc_id long, b array<int>, v array<double>, s array<double>").toArrow()
    table = table.sort_by([("doc_id", "ascending")])  # at most 2 * per_class rows of features, never texts
    lists = lambda name, kind: [np.array(x, kind) for x in table.column(name).to_pylist()]
    samples = list(zip(lists("b", np.int64), lists("v", float), lists("s", float), strict=True))
    return fit(samples, np.array(table.column("y").to_pylist(), int), sizes)


def score_documents(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """(doc_id, score) for every row, from its whole text and n_chars; null or empty texts have a score too."""

    def run(batches):
        for batch in batches:
            scores = [model.score(t.as_py(), n.as_py()) for t, n in zip(batch.column("text"), batch.column("n_chars"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars")).mapInArrow(run, f"doc_id {doc_type}, score double")


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; predicted is 1 from 0.7.

    ``doc_id``, ``lang``, ``source`` and labels are never inputs of a score. An empty table
    of documents gives an empty result; without labels every score is 1/2.
    """
    scored = score_documents(docs, train(docs, labels, per_class))
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts.

    Scores are taken beside the rows in the same pass, so texts are not shuffled. Null and
    empty texts are scored like others, repeated rows stay repeated, an empty table stays
    empty. Labels of fewer than two classes teach nothing: then every row stays.
    """
    model = train(docs, labels, per_class)
    if not model.fitted:
        return docs
    names = docs.columns

    def run(batches):
        for batch in batches:
            keep = [model.score(t.as_py(), n.as_py()) >= 0.7 for t, n in zip(batch.column("text"), batch.column("n_chars"), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema).select(*names)
