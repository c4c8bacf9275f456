"""Quality rules: per-text counts, and line frequency across the documents of a host.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed; for each host the distinct
texts that hold a line are counted, so exact copies count once.  A line is above the limits when more than
``min_docs`` distinct texts of its host, and more than ``share`` of them, hold it.  Lines above the limits are
removed; a document that keeps less than ``keep`` of its words is depleted and rejected.

Defined results: a null or empty text has no words and no lines and fails the base rules; a null host is a host of its
own; repeated rows are judged each, and count once as a text; an empty table gives an empty result; other columns are
not read.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import SPACE, fresh, stored, words

MIN_DOCS = 20
SHARE = 0.05
KEEP = 0.3
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _text_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(F.trim(F.regexp_replace(line, SPACE, " "))) > 0)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, text hash and the base counts of each row.

    Repeats of 3-word windows are found inside the row: a window's hash, its lowest bits replaced by
    the window's place, is sorted as a long; neighbours with equal high bits are the repeated windows."""
    cut = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        F.coalesce("text", F.lit("")).alias("body"),
    ).select(
        "doc_id",
        "host",
        F.xxhash64("body").alias("body_hash"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _text_lines(F.col("body")).alias("text_lines"),
        words(F.col("body")).alias("ws"),
    )
    counted = cut.select(
        "doc_id",
        "host",
        "body_hash",
        "n_symbols",
        (F.size("text_lines") - F.size(F.array_distinct("text_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("ws").cast("bigint").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("bigint").alias("word_chars"),
        "ws",
        # One bit more than the number of words needs.
        (F.pow(F.lit(2.0), F.length(F.bin(F.size("ws")))).cast("bigint") - 1).alias("low"),
    )
    windows = F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int"))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(F.get("ws", i), F.get("ws", i + 1), F.get("ws", i + 2))
        .bitwiseAND(F.bitwise_not("low"))
        .bitwiseOR(i.cast("bigint")),
    )
    keep = ["doc_id", "host", "body_hash", "n_symbols", "n_dup_lines", "n_words", "word_chars", "low"]
    packed = counted.select(*keep, F.sort_array(windows).alias("packed"))
    high = F.bitwise_not("low")

    def repeated(x: Column, i: Column) -> Column:
        own = x.bitwiseAND(high)
        return (own == F.get("packed", i - 1).bitwiseAND(high)) | (own == F.get("packed", i + 1).bitwiseAND(high))

    placed = packed.select(
        *keep[:-1],
        F.sort_array(F.transform(F.filter("packed", repeated), lambda x: x.bitwiseAND(F.col("low")))).alias("places"),
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(-3).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("total")),
        lambda acc, x: F.struct(
            x.alias("at"), (acc["total"] + F.least(F.lit(3).cast("bigint"), x - acc["at"])).alias("total")
        ),
        lambda acc: acc["total"],
    )
    return placed.select(*keep[:-1], covered.alias("n_repeat_words"))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, host, text hash, place, line hash, number of words."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select("doc_id", F.col("source").alias("host"), F.xxhash64(body).alias("body_hash"),
                    F.posexplode(F.split(body, "\n", -1)).alias("place", "line"))
        .withColumn("line", _normalised(F.col("line")))
        .where("line <> ''")
        .select("doc_id", "host", "body_hash", "place", F.xxhash64("line").alias("line_hash"),
                F.size(F.split("line", " ", -1)).alias("line_words"))
    )


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """host, line hash and number of distinct texts of the lines above the limits."""
    per_line = (
        line_rows(docs)
        .select("host", "line_hash", "body_hash")
        .distinct()
        .groupBy("host", "line_hash")
        .agg(F.count("*").alias("n_texts"))
        .where(F.col("n_texts") > min_docs)
    )
    hosts = (
        docs.select(F.col("source").alias("host"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("body_hash"))
        .distinct()
        .groupBy(F.col("host").alias("in_host"))
        .agg(F.count("*").alias("host_texts"))
    )
    return (
        per_line.join(hosts, F.col("host").eqNullSafe(F.col("in_host")))
        .where(F.col("n_texts") > share * F.col("host_texts"))
        .select("host", "line_hash", "n_texts")
    )


def removed_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Per document and text: places of the lines above the limits, and their words."""
    lines = line_rows(docs).alias("l")
    often = frequent_lines(docs, min_docs, share).alias("f")
    return (
        lines.join(often, F.expr("l.line_hash = f.line_hash AND l.host <=> f.host"), "left_semi")
        .groupBy("doc_id", "host", "body_hash", "place")
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("doc_id", "host", "body_hash")
        .agg(F.sum("line_words").alias("cut_words"), F.collect_list("place").alias("cut_places"))
    )


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, keep: float = KEEP) -> DataFrame:
    """Per row: base counts, ``base_failed``, words and places of removed lines, ``kept``."""
    # Stored first: a filter on the verdict must not be pushed into the counting expressions and repeat them.
    base = stored(base_counts(docs), "line-rules").alias("b")
    cut = removed_lines(docs, min_docs, share).alias("c")
    joined = base.join(
        cut,
        F.expr("b.doc_id <=> c.doc_id AND b.host <=> c.host AND b.body_hash = c.body_hash"),
        "left",
    ).select(
        "b.*",
        F.coalesce("c.cut_words", F.lit(0)).cast("bigint").alias("cut_words"),
        F.coalesce("c.cut_places", F.array().cast("array<int>")).alias("cut_places"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("cut_words") < keep * F.col("n_words")
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~depleted})


def clean(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents that are kept, without the lines above the limits; columns as given."""
    j_id, j_host, j_hash, j_places, own = (fresh(x) for x in ("id", "host", "hash", "places", "own"))
    verdict = (
        judge(docs, **limits)
        .where("kept")
        .select(F.col("doc_id").alias(j_id), F.col("host").alias(j_host), F.col("body_hash").alias(j_hash),
                F.col("cut_places").alias(j_places))
        .dropDuplicates([j_id, j_host, j_hash])
    )
    body = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.withColumn(own, F.xxhash64(body)).join(
        verdict,
        F.col("doc_id").eqNullSafe(F.col(j_id))
        & F.col("source").eqNullSafe(F.col(j_host))
        & (F.col(own) == F.col(j_hash)),
    )
    rest = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(j_places, i)), "\n"
    )
    text = F.when(F.size(j_places) > 0, rest).otherwise(F.col("text"))
    return joined.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)
