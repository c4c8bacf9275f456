"""Language of a text by a bit-sliced Bloom filter of its letter n-grams.

A text is lower-cased, its runs of other characters than letters become one blank, and each run of ``GRAM`` bytes is an n-gram.
Every position of the filter holds a bitmask over the languages, so the masks at the ``HASHES`` positions of an n-gram, taken
together by AND, name all languages whose set contains it.  Per-language popcounts over the n-grams of a text, corrected for
the false positives that the fill of each language's slice lets expect, decide; ties fall to the language first in order.

The sets come from a sample of about ``TRAIN_ROWS`` rows per language (the ``MAX_LANGS`` most frequent values of ``lang``),
chosen by hash outside the held-out quarter.  A language keeps n-grams that ``LEAST_DOCS`` of its sampled texts have, at a
rate of at least ``LEAST_RATE`` of the n-gram's highest rate in any language, and of these the ``KEEP`` most frequent.  All that
reaches the driver is the filter, whose size is fixed by ``POSITIONS`` and the number of languages.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything when no language was
learned.  A text with letters but no known n-gram gets the most frequent learned language, score 0.  A null doc_id is neither
learned from nor held out.  Repeated rows are predicted each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import in_arrow, in_chunks, stored

FOLDS, HELD_OUT = 4, 2
TRAIN_ROWS = 4_000
MAX_LANGS = 256
GRAM = 4
LEAST_DOCS = 2
LEAST_RATE = 0.1
KEEP = 30_000
POSITIONS = 1 << 19
HASHES = 3
UNKNOWN = "und"
# Languages per mask.
PLANE = 63

_LETTER = re.compile(r"[^\W\d_]")
_BLANKED = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_U = np.uint64


@dataclass
class Model:
    """``langs`` in order; ``masks`` (planes, POSITIONS); the expected rate of false positives per language."""

    langs: list[str] = field(default_factory=list)
    usual: int = 0
    masks: np.ndarray = field(default_factory=lambda: np.zeros((0, POSITIONS), dtype=np.int64))
    false_rate: np.ndarray = field(default_factory=lambda: np.zeros(0))


def remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def prepared(text: str) -> bytes:
    """Lower-cased words with one blank between, and before and after."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKED).split()) + b"  "


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts as integers, and how many each text has."""
    size = np.array([max(len(t) - GRAM + 1, 0) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint32)
    if len(data) < GRAM:
        return np.zeros(0, np.uint32), size
    whole = sum((data[k : len(data) - GRAM + 1 + k] << np.uint32(8 * (GRAM - 1 - k)) for k in range(GRAM)), np.uint32(0))
    ends = np.cumsum([len(t) for t in texts])
    across = (ends[:, None] - np.arange(1, GRAM)).ravel()  # begin in one text and end in the next
    inside = np.ones(len(whole), dtype=bool)
    inside[across[across < len(whole)]] = False
    return whole[inside], size


def positions(gram: np.ndarray) -> list[np.ndarray]:
    """The filter positions of n-grams, by double hashing."""
    h = gram.astype(_U) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    step = (h >> _U(40)) | _U(1)
    return [((h + _U(k) * step) & _U(POSITIONS - 1)).astype(np.int64) for k in range(HASHES)]


def _grams_by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, l (number of a language) -> l, gram, docs within a chunk."""
    for batch in in_chunks(batches, "text"):
        codes = []
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes.append(np.unique(grams([prepared(text)])[0]).astype(np.int64) | (lang << 32))
        code, docs = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array((code >> 32).astype(np.int32)), pa.array(code & 0xFFFFFFFF), pa.array(docs, pa.int64())],
            ["l", "gram", "docs"],
        )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """l, gram -> plane, position, bit."""
    for batch in batches:
        lang = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate(positions(batch.column(1).to_numpy(zero_copy_only=False)))
        lang = np.tile(lang, HASHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array((lang // PLANE).astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(np.left_shift(1, lang % PLANE))],
            ["plane", "at", "bit"],
        )


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    spark = docs.sparkSession
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder() != HELD_OUT))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return Model()
    langs = sorted(r["lang"] for r in sizes)
    number = {lang: k for k, lang in enumerate(langs)}
    # Few rows of fixed number, so a broadcast join.
    chosen = spark.createDataFrame([(r["lang"], number[r["lang"]], min(1.0, train_rows / r["n"])) for r in sizes], "lang string, l int, part double")
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id", "text"), F.lit(1 << 40)) < F.col("part") * (1 << 40)
    sample = stored(known.select("doc_id", "text", "lang").join(F.broadcast(chosen), "lang").where(drawn).select("text", "l"), "language-sample")
    rows = {r["l"]: r["n"] for r in sample.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = in_arrow(sample, _grams_by_lang, "l int, gram bigint, docs bigint").groupBy("l", "gram").agg(F.sum("docs").alias("docs"))
    counted = counted.where(F.col("docs") >= LEAST_DOCS)
    size = F.element_at(F.create_map(*(F.lit(x) for pair in rows.items() for x in pair)), F.col("l")) if rows else F.lit(1)
    rated = counted.withColumn("rate", F.col("docs") / size)
    rated = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= LEAST_RATE * F.col("top"))
    place = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("docs"), "gram"))
    best = rated.withColumn("place", place).where(F.col("place") <= KEEP).select("l", "gram")
    masks = in_arrow(best, _places, "plane int, at int, bit bigint").groupBy("plane", "at").agg(F.bit_or("bit").alias("mask"))
    table = masks.toArrow()
    held = np.zeros(((len(langs) - 1) // PLANE + 1, POSITIONS), dtype=np.int64)
    held[table["plane"].to_numpy(), table["at"].to_numpy()] = table["mask"].to_numpy()
    fill = np.array([np.count_nonzero(held[k // PLANE] >> (k % PLANE) & 1) / POSITIONS for k in range(len(langs))])
    return Model(langs, number[sizes[0]["lang"]], held, fill**HASHES)


def popcounts(model: Model, gram: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(texts, languages): the n-grams of each text that the filter gives to each language."""
    out = np.zeros((len(size), len(model.langs)), dtype=np.int64)
    filled = np.flatnonzero(size)
    if not len(filled):
        return out
    starts = np.r_[0, np.cumsum(size)[:-1]][filled]
    at = positions(gram)
    for plane, masks in enumerate(model.masks):
        held = masks[at[0]]
        for other in at[1:]:
            held &= masks[other]
        for k in range(plane * PLANE, min((plane + 1) * PLANE, len(model.langs))):
            out[filled, k] = np.add.reduceat((held >> (k % PLANE)) & 1, starts)
    return out


def decide(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    lettered = [t is not None and _LETTER.search(t) is not None for t in texts]
    gram, size = grams([prepared(t) if ok else b"" for t, ok in zip(texts, lettered)])
    if not model.langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    found = popcounts(model, gram, size)
    # Of n n-grams, n f are expected by false positives alone, and a share f of those not held by the language.
    true = np.maximum((found - size[:, None] * model.false_rate) / (1 - model.false_rate), 0.0)
    best = true.argmax(axis=1)
    total = true.sum(axis=1)
    value = np.where(total > 0, true[np.arange(len(true)), best] / np.where(total > 0, total, 1), 0.0)
    best = np.where(total > 0, best, model.usual)
    names = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
    return names, [float(v) if ok else 0.0 for v, ok in zip(value, lettered)]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            lang, score = decide(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", held_out, "text"), named, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
