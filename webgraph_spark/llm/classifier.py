"""Quality classifier learned from positives and unlabelled text.

Documents become ``FEATURES``, numbers that depend on their text alone. A linear model f minimises the non-negative unbiased
risk: with logistic loss l, prior p, positives P and unlabelled text U it is
p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]). Each Newton step is one pass of Spark over all training rows;
tasks return sums whose size depends on the number of features. Where the second part falls below zero, the step
goes against its gradient.

The prior is estimated without labels of the other kind: in the histograms of scores of all positives and all unlabelled
rows, the share of unlabelled over the share of positives above a threshold is smallest where no negative is left. The
threshold is chosen by that ratio plus a bound on its sampling error, so that few rows in the tail do not set it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.llm.common import held_part
from webgraph_spark.session import cut_lineage

SYMBOLS = frozenset(b"#*$%&|<>")
FEATURES = [
    "log_words",
    "log_word_length",
    "upper",
    "digits",
    "symbols",
    "marks",
    "commas",
    "other_marks",
    "beyond_ascii",
    "spaces",
    "shouted",
    "repeated_next",
    "log_per_distinct",
    "most_common",
    "ended",
    "log_line",
    "same_lines",
    "short_words",
    "long_words",
]

BINS = 2000
RISK = 0.1  # of the bound on the sampling error of the prior
RIDGE = 0.003  # of least mean risk on folds of training rows of two tables, see fold_risks
STEPS = 40  # at most; the last steps of a risk that is held at zero go to and fro
TOLERANCE = 1e-4
WIDEST = 6.0  # standardised features are clipped here


def _byte_classes() -> np.ndarray:
    """The class of each byte: 0 letters and the rest, then upper, digits, symbols, marks, commas, other marks, beyond ASCII, spaces."""
    table = np.zeros(256, np.int64)
    for b in range(256):
        if 65 <= b <= 90:
            table[b] = 1
        elif 48 <= b <= 57:
            table[b] = 2
        elif b in SYMBOLS:
            table[b] = 3
        elif b in b"!?":
            table[b] = 4
        elif b in b".,;:":
            table[b] = 5
        elif 33 <= b <= 126 and not chr(b).isalpha():
            table[b] = 6
        elif b >= 128:
            table[b] = 7
        elif b in b" \t\n\r\x0b\x0c":
            table[b] = 8
    return table


_CLASS = _byte_classes()


def features(text: str) -> list[float]:
    """The FEATURES of one text; all 0 for a text without words."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9) / len(data)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        np.log(n),
        np.log(lengths.mean()),
        *kinds[1:9],
        sum(map(bytes.isupper, words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        np.log(n / len(counts)),
        counts.most_common(1)[0][1] / n,
        sum(w[-1] in b".,;:!?" for w in words) / n,
        np.log(n / max(len(lines), 1)),
        1 - len(set(lines)) / max(len(lines), 1),
        (lengths <= 3).mean(),
        (lengths > 12).mean(),
    ]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(text.as_py() or "") for text in batch.column("text")]
        values = pa.array(found, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), values], ["doc_id", "held_out", "x"])


def featurise(docs: DataFrame, held_parts: int, held: int) -> DataFrame:
    """(doc_id, held_out, x) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (held_part("doc_id", held_parts) == held).alias("held_out"), "text")
    return rows.mapInArrow(_featured, "doc_id long, held_out boolean, x array<double>")


class Scaling(NamedTuple):
    """Features are standardised and clipped; a constant comes last."""

    mean: np.ndarray
    spread: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -WIDEST, WIDEST)
        return np.hstack([z, np.ones((len(z), 1))])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), len(FEATURES))


def _totals(rows: DataFrame, part) -> np.ndarray:
    """The sum over all batches of ``part(x, positive)``, a flat array; added up by Spark."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                found = part(_matrix(batch["x"]), batch["positive"].to_numpy(bool))
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "value": total})

    sums = rows.select("x", "positive").mapInPandas(summed, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([row["value"] for row in sums.orderBy("at").collect()])


def _scaling(rows: DataFrame) -> Scaling:
    size = len(FEATURES)

    def part(x, positive):
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = _totals(rows, part)
    mean = sums[1 : size + 1] / sums[0]
    spread = np.sqrt(np.maximum(sums[size + 1 :] / sums[0] - mean**2, 1e-8))
    return Scaling(mean, spread)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(f / 2))


def _fit(rows: DataFrame, scale: Scaling, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights that minimise the non-negative risk under ``prior``: Newton steps until none moves a weight by TOLERANCE."""
    size = len(FEATURES) + 1
    weights = np.zeros(size)
    for _ in range(STEPS):

        def part(x, positive, weights=weights):
            z = scale(x)
            f = z @ weights
            s = _sigmoid(f)
            loss = np.logaddexp(0, f)
            mine = [len(z), loss.sum(), *(s @ z), *((z * (s * (1 - s))[:, None]).T @ z).ravel()]
            p, sp = z[positive], s[positive]
            theirs = [len(p), loss[positive].sum(), *p.sum(axis=0), *(sp @ p), *((p * (sp * (1 - sp))[:, None]).T @ p).ravel()]
            return np.array([*mine, *theirs])

        sums = _totals(rows, part)
        n, loss_u = sums[0], sums[1] / sums[0]
        grad_u = sums[2 : 2 + size] / n
        curve_u = sums[2 + size : 2 + size + size**2].reshape(size, size) / n
        at = 2 + size + size**2
        m, loss_p = sums[at], sums[at + 1] / sums[at]
        sum_p = sums[at + 2 : at + 2 + size] / m
        grad_p = sums[at + 2 + size : at + 2 + 2 * size] / m
        curve_p = sums[at + 2 + 2 * size :].reshape(size, size) / m
        damping = ridge * np.eye(size)
        if loss_u - prior * loss_p >= 0:
            # l(f) - l(-f) = -f, so both parts together are convex.
            gradient = grad_u - prior * sum_p + ridge * weights
            step = -np.linalg.solve(curve_u + damping, gradient)
        else:
            gradient = grad_u - prior * grad_p
            step = 0.1 * np.linalg.solve(curve_u + prior * curve_p + damping, gradient)
        weights = weights + step
        if np.abs(step).max() < TOLERANCE:
            break
    return weights


def risk(rows: DataFrame, scale: Scaling, weights: np.ndarray, prior: float) -> float:
    """The non-negative risk of the weights on ``rows`` (x, positive), which hold positives."""

    def part(x, positive):
        f = scale(x) @ weights
        return np.array([len(f), np.logaddexp(0, f).sum(), positive.sum(), np.logaddexp(0, f[positive]).sum(), np.logaddexp(0, -f[positive]).sum()])

    n, as_negative, m, positive_as_negative, positive_as_positive = _totals(rows, part)
    return float(prior * positive_as_positive / m + max(0.0, as_negative / n - prior * positive_as_negative / m))


def fold_risks(rows: DataFrame, ridges: Sequence[float], folds: int = 3) -> dict[float, float]:
    """Per ridge, the mean risk on each fold of the training ``rows`` (x, positive, fold) of what the others teach.

    It reads training rows only: no held-out label, no label of 0. One prior, learned from all rows, weighs all of them.
    """
    prior = fit(rows).prior
    found: dict[float, list[float]] = {ridge: [] for ridge in ridges}
    for fold in range(folds):
        taught, asked = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        scale = _scaling(taught)
        for ridge in ridges:
            found[ridge].append(risk(asked, scale, _fit(taught, scale, prior, ridge), prior))
    return {ridge: float(np.mean(risks)) for ridge, risks in found.items()}


def _prior(rows: DataFrame, scale: Scaling, weights: np.ndarray) -> float:
    """The class prior of the unlabelled rows, from histograms of all scores."""

    def part(x, positive):
        at = np.minimum((_sigmoid(scale(x) @ weights) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[positive], minlength=BINS)]).astype(float)

    sums = _totals(rows, part)
    n, m = sums[:BINS].sum(), sums[BINS:].sum()
    above_u = np.cumsum(sums[:BINS][::-1]) / n
    above_p = np.maximum(np.cumsum(sums[BINS:][::-1]) / m, 1 / m)
    error = np.sqrt(np.log(4 / RISK) / 2) * (n**-0.5 + m**-0.5) / above_p
    best = np.argmin(above_u / above_p + error)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


class Model(NamedTuple):
    scale: Scaling
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale(x) @ self.weights)


def fit(rows: DataFrame) -> Model | None:
    """The model of the training ``rows`` (x, positive), all of them unlabelled but for the trusted positives.

    None without rows or without positives.
    """
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("positive"), 1)).alias("positives")).first()
    if not found["positives"]:
        return None
    scale = _scaling(rows)
    prior = _prior(rows, scale, _fit(rows, scale, 0.5))
    return Model(scale, _fit(rows, scale, prior), prior)


def classify(docs: DataFrame, labels: DataFrame, held_parts: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Trusted positives are training rows whose id has a label (doc_id, quality) of 1; labels of held-out rows and labels of 0
    are never read. NULL and empty texts have all features 0 and get the score of that. Equal texts get equal
    scores. Without positives every score is 0.5. An empty table gives an empty table.
    """
    rows = cut_lineage(featurise(docs, held_parts, held), "quality-features")
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    train = rows.where(~F.col("held_out")).join(trusted.withColumn("positive", F.lit(True)), "doc_id", "left")
    train = cut_lineage(train.select("x", F.coalesce("positive", F.lit(False)).alias("positive")), "quality-training")
    model = fit(train)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch.pop("x"))
            batch["score"] = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield batch

    scored = rows.mapInPandas(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
