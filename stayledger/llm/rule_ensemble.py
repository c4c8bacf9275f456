"""Quality by a sparse rule ensemble over text statistics.

Statistics of the text are Spark columns.  Shallow trees boosted on a sample of labelled rows give paths; each path is a
conjunctive rule; a lasso logistic regression gives most rules weight zero; the others are compiled to one Spark column,
so scoring runs inside the scan.  Labels are learned only from rows whose ``crc32(doc_id as text) mod 5`` is not 0.

The sample holds about ``TRAIN_ROWS`` labelled rows, chosen by a hash of doc_id; only it reaches the driver.

Defined results: null and empty texts have all statistics 0 and get the score of such a text; repeated rows are scored
each; repeated or null labels are used once per row or not at all; with no labelled rows, or labels of one class, the score is
the class share (0.5 without rows); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import words
from stayledger.llm.trees import grow, paths, predict

TRAIN_ROWS = 8_000
TREES = 24
DEPTH = 3
RATE = 0.3
PENALTY = 0.002
STEPS = 400
CUT = 0.3


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(text: Column, kinds: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, kinds, ""))


STATS = [
    "n_words", "word_length", "symbols", "capitals", "digits", "bars", "exclamations", "stops", "commas", "distinct_words",
    "repeated_next", "line_words", "distinct_lines", "alphabetic", "longest_word",
]


def with_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the statistics of each text."""
    cut = docs.select(*keep, F.coalesce("text", F.lit("")).alias("body")).select(
        *keep, "body", words(F.col("body")).alias("ws"), F.split("body", "\n", -1).alias("ls")
    )
    n, chars = F.size("ws"), F.length("body")
    lines = F.size("ls")
    following = F.size(F.filter("ws", lambda w, i: w == F.get("ws", i - 1)))
    values = {
        "n_words": n.cast("double"),
        "word_length": _share(F.length(F.array_join("ws", "")), n),
        "symbols": _share(_count(F.col("body"), r"[#*$%&<>^~_=@\\{}\[\]]"), chars),
        "capitals": _share(_count(F.col("body"), r"\p{Lu}"), chars),
        "digits": _share(_count(F.col("body"), r"[0-9]"), chars),
        "bars": _share(_count(F.col("body"), r"[|]"), chars),
        "exclamations": _share(_count(F.col("body"), r"[!?]"), chars),
        "stops": _share(_count(F.col("body"), r"[.]"), n),
        "commas": _share(_count(F.col("body"), r"[,;:]"), n),
        "distinct_words": _share(F.size(F.array_distinct("ws")), n),
        "repeated_next": _share(following, n),
        "line_words": _share(n, lines),
        "distinct_lines": _share(F.size(F.array_distinct("ls")), lines),
        "alphabetic": _share(_count(F.col("body"), r"\p{L}"), chars),
        "longest_word": F.coalesce(F.array_max(F.transform("ws", F.length)), F.lit(0)).cast("double"),
    }
    return cut.select(*keep, *(values[name].cast("double").alias(name) for name in STATS))


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """About ``rows`` labelled rows outside the held-out part, by a hash of doc_id; all, where there are fewer."""
    eligible = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    total = eligible.count()
    if total > rows:
        eligible = eligible.where(F.pmod(F.xxhash64("doc_id", F.lit(label)), 1_000_000) < int(1_000_000 * rows / total))
    return eligible.groupBy(F.col("doc_id").alias("label_id")).agg(F.max(label).cast("double").alias("y"))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def rules_of(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[tuple]:
    """Distinct paths of trees boosted on the logistic loss."""
    margin, found = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        tree = grow(x, y - _sigmoid(margin), depth, max(5, len(y) // 200))
        margin += RATE * 4 * predict(tree, x)
        for path in paths(tree):
            found.setdefault(tuple(sorted(path)), None)
    return list(found)


def covers(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for feature, at_most, cut in rule:
        out &= (x[:, feature] <= cut) if at_most else (x[:, feature] > cut)
    return out


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    bias, w = float(np.log(share / (1 - share))), np.zeros(r.shape[1])
    step = 4.0 / max(np.linalg.norm(np.c_[np.ones(len(r)), r].T @ np.c_[np.ones(len(r)), r], 2) / len(y), 1e-9)
    u, c, t = w.copy(), bias, 1.0
    for _ in range(steps):
        gap = _sigmoid(c + r @ u) - y
        new_bias = c - step * gap.mean()
        new = u - step * (r.T @ gap) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / t_next * (new - w), new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    return bias, w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[float, list[tuple[tuple, float]]]:
    """(intercept, weighted rules) of the rows in the sample."""
    sample = F.broadcast(labelled_sample(labels, "quality", rows))  # about ``rows`` rows by construction
    train = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id"))
    got = np.array([tuple(r) for r in with_stats(train, "y").collect()], dtype=float).reshape(-1, len(STATS) + 1)
    y, x = got[:, 0], got[:, 1:]
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return float(np.log(share / (1 - share))), []
    rules = rules_of(x, y)
    bias, w = lasso(np.stack([covers(rule, x) for rule in rules], axis=1).astype(float), y)
    return bias, [(rule, float(v)) for rule, v in zip(rules, w) if abs(v) > 1e-4]


def compiled(model: tuple[float, list[tuple[tuple, float]]]) -> Column:
    """The score as one column expression over the statistics."""
    bias, rules = model
    total = F.lit(bias)
    for rule, weight in rules:
        test = F.lit(True)
        for feature, at_most, cut in rule:
            value = F.col(STATS[feature])
            test = test & ((value <= cut) if at_most else (value > cut))
        total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``CUT`` on) of each row."""
    scored = with_stats(docs, "doc_id").select("doc_id", compiled(fit(docs, labels, rows)).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
