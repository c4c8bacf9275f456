"""Near-duplicates by 64-bit SimHash fingerprints, linked at 4 or fewer differing bits.

Fingerprints are indexed by position and byte.  Four differing bits touch at most four of the eight bytes, so linked
fingerprints share at least 4 positional bytes, and of any 7 positions at least 3.  Posting lists of one positional byte
would hold 1/256 of the table each, so a posting is keyed by three of the first seven positional bytes (35 postings a
fingerprint).  Inside a posting list shared bytes are tallied over all eight positions, pairs below four are dropped, and
the differing bits of the others are counted.

No pairs leave a list: it is explored breadth-first, each member compared with those not yet reached, and comes out
as one link per member to the smallest member of its part of the list.  All links lie in some list, so these
links join the same documents.  A list longer than ``BLOCK`` is cut into blocks by a hash, and each two blocks
are explored as a list of their own, so that no task holds more than two blocks.

Defined results: null, empty and blank texts have fingerprint zero and are linked like others; texts of under four words
have one shingle; repeated rows share fingerprint and component; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import fresh, in_arrow, in_chunks, stored
from stayledger.llm.components import components

MAX_BITS = 4
SHINGLE = 4
SEED = 42
SHARED = 8 - MAX_BITS
POSTINGS = list(combinations(range(7), SHARED - 1))
BLOCK = 20_000


def fingerprint(text: str | None) -> int:
    """SimHash of one text as a signed 64-bit number: A-Z lower-cased, 4-word shingles with repeats, majority of bits."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in ws])
        starts = (ends - [len(w) + 1 for w in ws]).tolist()
        stops = (ends - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops[SHINGLE - 1 :])]
    set_bits = np.zeros(64, dtype=np.int64)
    raw = np.array(hashes, dtype="<u8")
    for at in range(0, len(raw), 1 << 16):  # bounded memory for very long texts
        part = raw[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(set_bits * 2 > len(raw), bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text"):
        values = [fingerprint(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.int64()), batch.column(2)], ["doc_id", "fp", "body_hash"]
        )


def _body_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number) and text hash of each row."""
    cut = docs.select(F.col("doc_id").cast("bigint"), "text", _body_hash().alias("body_hash"))
    return in_arrow(cut, _fingerprints, "doc_id bigint, fp bigint, body_hash bigint")


def postings(fps: DataFrame) -> DataFrame:
    """(posting, fp): 35 rows per fingerprint; a posting is its number and three positional bytes."""
    keys = [
        F.lit(i * 2**24)
        + sum(
            F.shiftright("fp", 8 * position).bitwiseAND(F.lit(255)) * F.lit(256**k)
            for k, position in enumerate(positions)
        )
        for i, positions in enumerate(POSTINGS)
    ]
    return fps.select(F.explode(F.array(*keys)).alias("posting"), "fp")


def _lists(fps: DataFrame) -> DataFrame:
    """(posting, part, fp) of the posting lists with two members at least; long lists by pairs of blocks."""
    index = postings(fps)
    sizes = index.groupBy(F.col("posting").alias("p")).agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes an explode by its input, so it would take these millions of keys for a small table and broadcast them.
    joined = index.join(sizes.hint("merge"), F.col("posting") == F.col("p"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("block")), blocks).cast("int")
    # Block pair (a, b), a <= b: a member of block x is in (x, y) and (y, x) for every y.
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda y: F.least(own, y) * blocks + F.greatest(own, y)
    )
    return joined.select("posting", F.explode(F.when(F.col("n") > BLOCK, pairs).otherwise(F.array(F.lit(0)))).alias("part"), "fp")


def linked(values: np.ndarray) -> np.ndarray:
    """For distinct fingerprints of one list: the smallest member that each reaches by links inside the list."""
    order = np.sort(values)
    bits = order.view(np.uint64)
    by = order.view(np.uint8).reshape(-1, 8)
    root = order.copy()
    left = np.arange(len(order))
    while len(left):
        first, left = left[0], left[1:]
        frontier = [first]
        while frontier and len(left):
            at = frontier.pop()
            tally = (by[left] == by[at]).sum(axis=1)
            near = tally >= SHARED
            near[near] = np.bitwise_count(bits[left[near]] ^ bits[at]) <= MAX_BITS
            reached = left[near]
            root[reached] = order[first]
            frontier.extend(reached.tolist())
            left = left[~near]
    return np.stack([order, root])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (posting, part): explore list after list; a list may span batches."""

    def out(pairs: list[np.ndarray]) -> pa.RecordBatch:
        u, v = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
        moved = u != v
        return pa.RecordBatch.from_arrays([pa.array(u[moved]), pa.array(v[moved])], ["u", "v"])

    rest_key, rest = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        posting, part, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cuts = np.flatnonzero((posting[1:] != posting[:-1]) | (part[1:] != part[:-1])) + 1
        bounds = [0, *cuts.tolist(), len(fp)]
        pairs = []
        for a, b in zip(bounds, bounds[1:]):
            key = (posting[a], part[a])
            if key != rest_key:
                if rest:
                    pairs.append(linked(np.concatenate(rest)))
                rest_key, rest = key, []
            rest.append(fp[a:b])
        yield out(pairs)
    if rest:
        yield out([linked(np.concatenate(rest))])


def links(fps: DataFrame) -> DataFrame:
    """(u, v): links that join exactly the fingerprints that the full set of links joins; ``fps`` are distinct."""
    lists = _lists(fps)
    # Parallelism comes from the exchange the sort needs; its number of partitions follows the session.
    dealt = lists.repartition("posting", "part").sortWithinPartitions("posting", "part", "fp")
    return dealt.mapInArrow(_links, "u bigint, v bigint")


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, fp, text hash, component_id and the group's own mark (its smallest fingerprint) of each row."""
    marks = stored(fingerprints(docs), "fingerprints")
    nodes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = components(links(nodes.select("fp")))
    by_fp = (
        nodes.join(roots, nodes.fp == roots.node, "left")
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    )
    by_fp = stored(by_fp, "roots")
    least = by_fp.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("component_id"))
    named = by_fp.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("n_fp"), "component_id", "root")
    return marks.join(named, F.col("fp") == F.col("n_fp")).select("doc_id", "fp", "body_hash", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of each row."""
    return _grouped(docs).select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    """16 lower-case hex digits of the unsigned value."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, that of the smallest doc_id and of its texts the one of the smallest hash; columns as given.

    A row with a null doc_id is kept only where its group has no other; groups of null doc_ids only keep one row each."""
    own, first_id, first_hash = (fresh(x) for x in ("own", "first_id", "first_hash"))
    firsts = (
        _grouped(docs)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("component_id").alias(first_id), F.min("body_hash").alias(first_hash))
        .select(first_id, first_hash)
    )
    joined = docs.withColumn(own, _body_hash()).join(
        firsts,
        F.col("doc_id").cast("bigint").eqNullSafe(F.col(first_id)) & (F.col(own) == F.col(first_hash)),
        "left_semi",
    )
    return joined.dropDuplicates(["doc_id", own]).select(*docs.columns)
