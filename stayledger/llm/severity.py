"""Toxicity as an expected severity, by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(cut_k - w . x): one weight vector serves all ordered thresholds.  The grades are 0 for rows
labelled clean and 1 to 3 for rows labelled toxic, by thirds of their number of marker features.  Features are words and
their beginnings of four to six letters (so that inflected forms count together), valued log(1 + count).

The table of labels is met by a sample of about ``TRAIN_ROWS`` labelled rows outside the held-out part (see
``rule_ensemble``); document counts of features are taken by Spark over the sample's texts, and the ``VOCABULARY``
features that tell the classes apart best are kept.  Weights are fitted on the driver from these bounded tables.

Defined results: null and empty texts have no features and the severity of such a text; repeated rows are scored each;
with no toxic or no clean labelled rows every severity is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import in_arrow, in_chunks, stored
from stayledger.llm.rule_ensemble import labelled_sample

TRAIN_ROWS = 8_000
VOCABULARY = 600
# A feature counts when this many of the sample's texts have it, and this share of them.
LEAST_TEXTS = 5
LEAST_SHARE = 0.001
GRADES = 4
TOXIC_FROM = 0.25
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, 30.0))



def features(word: str) -> list[str]:
    """The word, and its beginnings marked by an asterisk."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)]


def vector(text: str | None, vocabulary: dict[str, int], known: dict[str, list[int]]) -> tuple[list[int], list[float]]:
    """Indices and values of a text's features; ``known`` remembers the features of words."""
    counts: Counter = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        hits = known.get(word)
        if hits is None:
            hits = [vocabulary[f] for f in features(word) if f in vocabulary]
            if len(known) < 200_000:
                known[word] = hits
        for j in hits:
            counts[j] += n
    return list(counts), [float(np.log1p(n)) for n in counts.values()]


def fit_ordinal(rows: list[tuple[list[int], list[float]]], y: np.ndarray, width: int, steps: int = 600, ridge: float = 2e-4):
    """(weights, increasing cuts) by Adam on the mean log likelihood with an L2 penalty."""
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    col = np.array([j for i, _ in rows for j in i], dtype=int)
    val = np.array([v for _, vs in rows for v in vs])
    # Rows of a class weigh alike, so a rare grade is not drowned.
    size = np.bincount(y, minlength=GRADES)
    weight = (1 / np.maximum(size, 1) ** 0.5)[y]
    weight /= weight.sum()
    w, raw = np.zeros(width), np.array([1.0] + [0.0] * (GRADES - 2))  # cuts: first, then log gaps
    m, v = np.zeros(width + GRADES - 1), np.zeros(width + GRADES - 1)
    for step in range(1, steps + 1):
        cuts = np.r_[raw[0], raw[0] + np.cumsum(np.exp(raw[1:]))]
        z = np.bincount(at, weights=val * w[col], minlength=len(rows))
        upper = 1 / (1 + np.exp(-np.clip(np.r_[cuts, 40.0][y] - z, -40, 40)))
        lower = 1 / (1 + np.exp(-np.clip(np.r_[-40.0, cuts][y] - z, -40, 40)))
        du, dl = upper * (1 - upper), lower * (1 - lower)
        p = np.maximum(upper - lower, 1e-9)
        gz = weight * (du - dl) / p
        gw = np.bincount(col, weights=val * gz[at], minlength=width) + ridge * w
        gcut = np.zeros(GRADES - 1)
        np.add.at(gcut, y[y < GRADES - 1], -(weight * du / p)[y < GRADES - 1])
        np.add.at(gcut, y[y > 0] - 1, (weight * dl / p)[y > 0])
        graw = np.r_[gcut.sum(), [np.exp(raw[k]) * gcut[k:].sum() for k in range(1, GRADES - 1)]]
        g = np.r_[gw, graw]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, raw = w - move[:width], raw - move[width:]
    return w, np.r_[raw[0], raw[0] + np.cumsum(np.exp(raw[1:]))]


def expected(z: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Expected grade: the sum over thresholds of P(grade > k)."""
    return (1 / (1 + np.exp(np.clip(cuts[None, :] - np.asarray(z)[:, None], -40, 40)))).sum(axis=1)


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text"):
        texts, ys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found = [sorted({f for w in set(_WORD.findall((t or "").lower())) for f in features(w)}) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(ys, pa.float64()), pa.array(found, pa.list_(pa.string()))], ["y", "found"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY) -> Model:
    sample = F.broadcast(labelled_sample(labels, "toxic", rows))  # about ``rows`` rows by construction
    train = stored(
        docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id")).select("text", "y"), "toxic"
    )
    total, toxic = train.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not 0 < toxic < total:
        return Model()
    # Document counts by class, and how far the toxic share of a feature's texts is from the general one.
    share = toxic / total
    counted = (
        in_arrow(train, _sampled_features, "y double, found array<string>")
        .select("y", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("n"), F.sum("y").alias("k"))
        .where(F.col("n") >= max(LEAST_TEXTS, LEAST_SHARE * total))
        .withColumn("z", (F.col("k") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share)))
    )
    best = counted.orderBy(F.abs("z").desc(), "feature").limit(vocabulary).collect()
    index = {r["feature"]: j for j, r in enumerate(best)}
    # Markers: at least half of the texts that hold the feature are toxic, beyond chance.
    marker = np.array([r["z"] > 4 and r["k"] >= 0.5 * r["n"] for r in best])
    got = train.select("text", "y").toLocalIterator()
    known: dict[str, list[int]] = {}
    vectors, y, count = [], [], []
    for text, label in got:
        ids, values = vector(text, index, known)
        vectors.append((ids, values))
        y.append(label)
        count.append(sum(np.expm1(v) for j, v in zip(ids, values) if marker[j]))
    y, count = np.array(y), np.array(count)
    thirds = np.quantile(count[y > 0], [1 / 3, 2 / 3])
    grade = np.where(y > 0, 1 + (count > thirds[0]) + (count > thirds[1]), 0).astype(int)
    w, cuts = fit_ordinal(vectors, grade, len(index))
    return Model(index, w, cuts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_severity (0 to 3), severity (most likely whole grade) and toxic of each row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights, model.cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, w, cuts = shared.value
        known: dict[str, list[int]] = {}
        for batch in in_chunks(batches, "text"):
            z = np.array([
                float(np.dot(w[ids], values)) if ids else 0.0
                for ids, values in (vector(t, index, known) for t in batch.column(1).to_pylist())
            ])
            level = expected(z, cuts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(level, pa.float64()), pa.array(np.rint(level).astype(np.int32)),
                 pa.array(level >= TOXIC_FROM)],
                ["doc_id", "expected_severity", "severity", "toxic"],
            )

    schema = "doc_id bigint, expected_severity double, severity int, toxic boolean"
    return in_arrow(docs.select(F.col("doc_id").cast("bigint"), "text"), run, schema)
