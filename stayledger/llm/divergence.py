"""How far the sources of a language differ in their words, by exact smoothed frequencies.

Terms are runs of ASCII letters and of characters beyond ASCII, lower-cased in A-Z only.  A translate table lowers the
letters and blanks every other byte of a document in one pass, ``bytes.split`` cuts it, and one Counter per document gives its
frequencies.  A task adds them up per (lang, source); Spark sums the sparse counts.

A language keeps the terms that ``LEAST_DOCS`` of its documents have.  A group (lang, source), and a language, gives each kept term
p = 1 + floor(10^9 (count + 2) / (N + 2V)), with N the sum of its counts and V the number of kept terms.  Two shares differ by
f = floor((p - q)^2 / (p + q)).

``pairs`` sums f over all kept terms for each two sources of a language.  The sources of a language are dealt into blocks
of about ``BLOCK``; a task holds one pair of blocks and one slice of the terms, and adds to a matrix with an entry for each two
sources, which is the size of the result.  Terms that neither block has enter as one product.

Defined results: null text, lang and source count as ''; every row is a document, repeated rows too; a group without terms,
or of a language that keeps none, still has its pairs; a source alone in its language has none; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import in_arrow, in_chunks, sized, stored

LEAST_DOCS = 10
TOP_TERMS = 10
BLOCK = 64
# Counts a task holds before it hands them on, and terms of one step of the matrices.
HELD = 400_000
STEP = 512

_BLANKED = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def frequencies(raw: bytes) -> Counter:
    """Terms of one document with their numbers of occurrences."""
    return Counter(raw.translate(_BLANKED).split())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> lang, source, term, n, docs, added up over many documents."""
    n: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for key, counted in n.items():
            terms = list(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(terms)), pa.array([key[1]] * len(terms)), pa.array(terms, pa.binary()),
                 pa.array(list(counted.values()), pa.int64()), pa.array([docs[key][t] for t in terms], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for part in in_chunks([batch], "text"):
            for lang, source, raw in zip(*(part.column(i).to_pylist() for i in range(3))):
                one = frequencies(raw)
                if one:
                    n.setdefault((lang, source), Counter()).update(one)
                    docs.setdefault((lang, source), Counter()).update(one.keys())
        if sum(map(len, n.values())) > HELD:
            yield from handed_on()
            n, docs = {}, {}
    yield from handed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n occurrences, docs with it."""
    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    parts = in_arrow(rows, _counts, "lang string, source string, term binary, n bigint, docs bigint")
    parts = parts.withColumn("term", F.col("term").cast("string"))
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)); the product passes 64 bits."""
    scaled = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    whole = F.call_function("div", scaled, (total + 2 * kept).cast("decimal(19,0)"))
    return (1 + whole).cast("bigint")


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of shares, whose squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class _Matrix:
    """Sums of differences between the sources of two blocks, over the terms of a slice."""

    def __init__(self) -> None:
        self.at: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.base: tuple[list[int], list[int]] = ([], [])
        self.seen = 0
        self.term: str | None = None
        self.filled: tuple[list, list] = ([], [])
        self.sums: np.ndarray | None = None

    def source(self, side: int, name: str, base: int) -> None:
        self.at[side][name] = len(self.base[side])
        self.base[side].append(base)

    def add(self, side: int, name: str, term: str, p: int) -> None:
        if term != self.term:
            if self.term is not None and self.seen % STEP == 0:
                self.fold()
            self.term, self.seen = term, self.seen + 1
        self.filled[side].append(((self.seen - 1) % STEP, self.at[side][name], p))

    def fold(self) -> None:
        rows = (self.seen - 1) % STEP + 1 if self.seen else 0
        dense = []
        for base, filled in zip(self.base, self.filled):
            full = np.tile(np.array(base, dtype=np.int64), (rows, 1))
            if filled:
                term, source, p = np.array(filled, dtype=np.int64).T
                full[term, source] = p
            dense.append(full)
        left, right = dense
        if self.sums is None:
            self.sums = np.zeros((len(self.base[0]), len(self.base[1])), dtype=np.int64)
        for i in range(left.shape[1] if rows else 0):
            p = left[:, i : i + 1]
            self.sums[i] += ((p - right) ** 2 // (p + right)).sum(axis=0)
        self.filled = ([], [])

    def rows(self, lang: str, same: bool) -> pa.RecordBatch:
        """Each two sources once; ``same``: both sides are one block."""
        if self.sums is None or self.filled[0] or self.filled[1]:
            self.fold()
        one, other = (np.array(list(at), dtype=object) for at in self.at)
        i, j = (x.ravel() for x in np.indices(self.sums.shape))
        value = self.sums.ravel()
        if same:
            chosen = np.flatnonzero(i < j)
            i, j, value = i[chosen], j[chosen], value[chosen]
        base = [np.array(b, dtype=np.int64) for b in self.base]
        columns = [
            pa.array([lang] * len(i), pa.string()), pa.array(one[i], pa.string()), pa.array(other[j], pa.string()),
            pa.array(value, pa.int64()), pa.array(np.full(len(i), self.seen), pa.int64()),
            pa.array(base[0][i], pa.int64()), pa.array(base[1][j], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "one", "other", "value", "seen", "p", "q"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, i, j, slice, term), sources first: sums of each two sources of blocks i and j."""
    key, held = None, None
    for batch in batches:
        for lang, i, j, cut, term, source, block, p in zip(*(c.to_pylist() for c in batch.columns)):
            if (lang, i, j, cut) != key:
                if held is not None:
                    yield held.rows(key[0], key[1] == key[2])
                key, held = (lang, i, j, cut), _Matrix()
            for side, mine in enumerate((i, j)):
                if block == mine:
                    if term is None:
                        held.source(side, source, p)
                    else:
                        held.add(side, source, term, p)
    if held is not None:
        yield held.rows(key[0], key[1] == key[2])


def _pair_values(own: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language.  ``own``: lang, source, term, p and block of the counted
    terms; ``groups``: lang, source, total, kept, base, block, blocks."""
    slices = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j"))))
    # Each slice of the terms knows all sources of its blocks.
    heads = groups.select("lang", "source", "block", "blocks", F.col("base").alias("p"), F.lit(None).cast("string").alias("term"),
                          F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("cut"))
    rows = own.select("lang", "source", "block", "blocks", "p", "term", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("cut"))
    dealt = heads.unionByName(rows).withColumn("at", each)
    dealt = dealt.select("lang", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "cut", "term", "source", "block", "p")
    placed = dealt.repartition("lang", "i", "j", "cut").sortWithinPartitions("lang", "i", "j", "cut", F.col("term").asc_nulls_first(), "source")
    sums = in_arrow(placed, _sums, "lang string, one string, other string, value bigint, seen bigint, p bigint, q bigint")
    each_two = ["lang", F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other")]
    turned = F.col("one") > F.col("other")
    summed = sums.groupBy(*each_two).agg(
        F.sum("value").alias("value"),
        F.sum("seen").alias("seen"),
        F.max(F.when(turned, F.col("q")).otherwise(F.col("p"))).alias("p"),
        F.max(F.when(turned, F.col("p")).otherwise(F.col("q"))).alias("q"),
    )
    kept = sized(groups.groupBy("lang").agg(F.max("kept").alias("kept")))
    unseen = (F.col("kept") - F.col("seen")) * difference(F.col("p"), F.col("q"))
    value = (F.col("value") + F.when(F.col("kept") > 0, unseen).otherwise(0)).cast("bigint")
    both_ways = F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item")),
    )
    return summed.join(kept, "lang").select("lang", F.inline(both_ways), value.alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank: the distance to each other source of the language, and the terms
    by which a group stands out from its language."""
    known = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = stored(term_counts(known), "term-counts")
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n")
    )
    own = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-counts")
    langs = own.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = known.select("lang", "source").distinct()
    blocks = found.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    groups = (
        found.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
        .na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("base", F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0))
        .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    )
    groups = sized(stored(groups, "source-groups"))
    own = own.join(groups, ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("kept")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("kept")),
    })
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = (
        own.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )
    pairs = _pair_values(own, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)
