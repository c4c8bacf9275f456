"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.session import pin, scratch_path

SPACE = r"[\x20\x09-\x0D]+"
SPAN = "struct<start:int,end:int,hit:string>"
NO_SPANS = f"array<{SPAN}>"
# A table is broadcast only below this many counted rows; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Bytes of text a Python task holds at a time, and rows of an Arrow batch.
CHUNK_BYTES = 8 << 20
BATCH_ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors,
    and unlike a checkpoint it is columnar and compressed."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already stored or pinned) with a broadcast hint if it is counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and tab to carriage return; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def located(text: Column, pattern: str | Column) -> Column:
    """Leftmost non-overlapping matches with code-point offsets, end exclusive.

    The pieces between the matches give the offsets, so no row leaves the JVM.
    The pattern must not match the empty string."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    parts = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)))
    parts = F.filter(parts, lambda p: p["1"].isNotNull())
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["0"])
        end = start + F.length(part["1"])
        span = F.struct(start.alias("start"), end.alias("end"), part["1"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(parts, begin, step, lambda acc: acc["spans"])


def gated(gate: Column, spans: Column) -> Column:
    """``spans`` where the cheap test holds, else none."""
    return F.when(gate, spans).otherwise(F.array().cast(NO_SPANS))


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans with kind and rank, in the field order they sort by."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, for sorted tagged spans."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """Text with each span (start, end, and a ``mask`` text) replaced; overlapping spans merge into the first.

    ``spans`` must be sorted by start."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        piece = F.when(span["start"] >= acc["at"], F.concat(gap, span["mask"])).otherwise(F.lit(""))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"), F.concat(acc["out"], piece).alias("out")
        )

    return F.aggregate(
        spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )


def in_chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that one holds about ``CHUNK_BYTES`` of ``column`` or a single row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.names.index(column))).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > begin and held + size > CHUNK_BYTES:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches short enough for long texts."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def fresh(label: str) -> str:
    return f"_{label}_{uuid.uuid4().hex[:8]}"


__all__ = [
    "BROADCAST_ROWS", "SPACE", "fresh", "gated", "in_arrow", "in_chunks", "listed", "located", "masked", "pin",
    "read", "sized", "stored", "tagged", "words",
]
