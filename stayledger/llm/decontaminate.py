"""Benchmark decontamination by multi-pattern search with block shift tables, over words.

Patterns are the windows of the benchmark items: 10 consecutive words, or all words of a shorter item.  The text is
searched word by word instead of letter by letter.  For patterns of m words, the pair of words that ends at a place tells
how far the search may jump: m - 1 if no pattern has the pair, else the least distance of the pair to a pattern's
end.  At distance 0 the patterns whose last words hash alike are taken from a bucket and compared word for word.
Patterns of one length share tables, so a short item does not shorten the jumps of the others.

The windows are made by Spark and stored.  Up to ``CHUNK`` patterns are searched in one pass.  More are dealt by hash into
chunks of about that size; one chunk after another is read, sent to the executors, searched for in all documents and
let go, so that memory does not grow with the benchmark.  The hits of a text are stored and joined back to its rows.

Defined results: null, empty and wordless texts have no words and no hits; an item without words (or null) has no
windows; every row comes back, whatever the number of chunks; repeated item_ids count once; an empty benchmark hits
nothing; other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm.common import fresh, in_arrow, in_chunks, sized, stored

WINDOW = 10
CHUNK = 100_000
# Letters a-z, digits and all bytes of other alphabets stay; capitals are lowered; the rest separates.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
FOUND = "doc_id bigint, body_hash bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Matcher:
    """Tables of one chunk of patterns: {window: items}."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.tables = []
        for m in sorted({len(p) for p in patterns}):
            mine = {p: ids for p, ids in patterns.items() if len(p) == m}
            block = min(2, m)
            shift: dict = {}
            buckets: dict = {}
            for p in mine:
                for end in range(block, m + 1):
                    key = p[end - block : end]
                    shift[key] = min(shift.get(key, m - block + 1), m - end)
                buckets.setdefault(hash(p[-block:]), []).append(p)
            self.tables.append((m, block, shift, buckets))
        self.items = patterns

    def search(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of words inside occurrences, and the items with occurring windows."""
        found, items = [], set()
        for m, block, shift, buckets in self.tables:
            jump, n, end = m - block + 1, len(ws), m
            get = shift.get
            while end <= n:
                key = (ws[end - 2], ws[end - 1]) if block == 2 else (ws[end - 1],)
                step = get(key, jump)
                if step:
                    end += step
                    continue
                for p in buckets[hash(key)]:
                    if tuple(ws[end - m : end]) == p:
                        found.append((end - m, end))
                        items.update(self.items[p])
                end += 1
        return merge(found), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def windows(text: str | None) -> set[tuple[bytes, ...]]:
    ws = split_words(text)
    m = min(WINDOW, len(ws))
    return {tuple(ws[i : i + m]) for i in range(len(ws) - m + 1)} if ws else set()


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text"):
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = [b" ".join(p) for p in windows(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary())], ["item", "pattern"]
            )


def pattern_rows(benchmark: DataFrame) -> DataFrame:
    """Distinct (item, pattern): the windows of each item, words joined by spaces."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return in_arrow(items, _window_rows, "item string, pattern binary").distinct()


def _patterns(rows: DataFrame) -> dict[tuple[bytes, ...], list[str]]:
    """Patterns of one chunk with their items."""
    chunk: dict[tuple[bytes, ...], list[str]] = {}
    for item, pattern in rows.select("item", "pattern").toLocalIterator():
        chunk.setdefault(tuple(bytes(pattern).split(b" ")), []).append(item)
    return chunk


def _sent(spark: SparkSession, patterns: dict[tuple[bytes, ...], list[str]]) -> Broadcast:
    return spark.sparkContext.broadcast(json.dumps([[[w.decode("latin-1") for w in p], ids] for p, ids in patterns.items()]))


def _searched(docs: DataFrame, plain: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher({tuple(w.encode("latin-1") for w in p): ids for p, ids in json.loads(plain.value)})
        schema = pa.schema([
            ("doc_id", pa.int64()), ("body_hash", pa.int64()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())),
        ])
        for batch in in_chunks(batches, "text"):
            rows = []
            for doc_id, text, body_hash in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ws = split_words(text)
                spans, items = matcher.search(ws)
                rows.append({
                    "doc_id": doc_id, "body_hash": body_hash, "n_words": len(ws),
                    "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items, key=lambda x: (x is None, x)),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return in_arrow(docs.select(F.col("doc_id").cast("bigint"), "text", _body_hash().alias("body_hash")), run, FOUND)


def _body_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, merged spans of hit words, items with occurring windows (sorted as text)."""
    return _found(docs, benchmark).select("doc_id", "n_words", "spans", "items")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``search`` with the text hash of each row."""
    spark = docs.sparkSession
    rows = stored(pattern_rows(benchmark), "patterns")
    chunks = math.ceil(rows.select("pattern").distinct().count() / CHUNK)
    if chunks <= 1:
        return _searched(docs, _sent(spark, _patterns(rows)))
    dealt = stored(
        rows.withColumn("chunk", F.pmod(F.xxhash64("pattern"), F.lit(chunks)).cast("int"))
        .repartition("chunk")
        .sortWithinPartitions("chunk"),
        "chunks",
    )
    hits = None
    for k in range(chunks):
        plain = _sent(spark, _patterns(dealt.where(F.col("chunk") == k)))
        # Copies of a row have the same hits; spans of a text are few beside its words.
        some = _searched(docs, plain).where(F.size("spans") > 0).dropDuplicates(["doc_id", "body_hash"])
        some = stored(some.select("doc_id", "body_hash", "spans", "items"), "hits")
        plain.destroy()
        hits = some if hits is None else hits.unionByName(some)
    whole = (
        hits.groupBy(F.col("doc_id").alias("h_id"), F.col("body_hash").alias("h_hash"))
        .agg(F.flatten(F.collect_list("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("i"))
        .select("h_id", "h_hash", _merged(F.array_sort("s")).alias("h_spans"), F.col("i").alias("h_items"))
    )
    every = _searched(docs, _sent(spark, {}))
    own = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("body_hash") == F.col("h_hash"))
    return every.join(sized(stored(whole, "hits")), own, "left").select(
        "doc_id",
        "body_hash",
        "n_words",
        F.coalesce("h_spans", "spans").alias("spans"),
        F.coalesce("h_items", "items").alias("items"),
    )


def _merged(spans):
    """Sorted spans, overlapping and touching ones joined."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, s):
        last = F.get(acc, F.size(acc) - 1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joins = (F.size(acc) > 0) & (s["start"] <= last["end"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(acc, F.array(s))
        )

    return F.aggregate(spans, none, step)


def n_hit(spans: str = "spans"):
    return F.aggregate(
        spans, F.lit(0).cast("bigint"), lambda acc, s: acc + (s["end"] - s["start"]).cast("bigint")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any window of the benchmark; columns as given."""
    hit_id, hit_hash = fresh("id"), fresh("hash")
    hit = (
        _found(docs, benchmark)
        .where(F.size("spans") > 0)
        .select(F.col("doc_id").alias(hit_id), F.col("body_hash").alias(hit_hash))
        .distinct()
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(hit_id)) & (_body_hash() == F.col(hit_hash))
    return docs.join(hit, same, "left_anti")
