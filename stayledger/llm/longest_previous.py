"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in a document of smaller doc_id, or earlier in
its own); the first copy stays.  In terms of suffixes: a string at p goes if its longest previous factor is ``LENGTH`` or
longer, and the match is one of the neighbours of smaller position in suffix order.

The suffixes of all documents are not sorted as one; they are sorted in buckets that are known to hold all candidates:

1. Every window of ``LENGTH`` bytes selects its smallest ``GRAM``-byte hash, leftmost on ties.  Equal windows select equal
   grams at equal offsets, so each match of two windows shows in the bucket of one gram.  About one byte in 39 is selected.
   The context of a selected gram is the union of the windows that hold it.
2. Grams are grouped by hash, and by hash of the whole context.  Copies after the first of a whole context go at once:
   first inside a stretch of text, before anything is shuffled, then across the corpus.
3. Where one gram is left with several contexts, their bytes are read and dealt by longer keys.  Equal windows with l bytes
   left of the gram, and LEFT - l right of it, agree on these; in steps of ``STEP`` bytes each l belongs to one of four keys
   (a steps left, the gram, 3 - a steps right: 81 bytes).  So a context gives at most four rows, each window in one of them.
4. The windows of a bucket are sorted as suffixes; LPF over previous and next smaller positions marks the repeated ones.
   A bucket of more than ``CROWD`` rows is cut into parts by hash; what is first in its part is told by the
   smallest place per window over all parts, so that no task holds a bucket that grows with the corpus.

Defined results: matches never cross documents; null and empty texts have nothing to remove; a null doc_id counts as the
smallest; rows of one doc_id and text are one document and come back each; different texts under one doc_id are documents
of their own, in the order of their hashes; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import in_arrow, in_chunks, sized, stored

LENGTH = 100
GRAM = 24
LEFT = LENGTH - GRAM
STEP = LEFT // 4
CROWD = 5_000
# Bytes of a document handled at a time, and windows sorted at a time.
SEGMENT = 4 << 20
WINDOWS = 1 << 16
NULL_ID = -(2**63)
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MARKS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
MARKED = "h bigint, c bigint, doc_id bigint, body bigint, start int, stop int, anchor int"


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS = _powers(1 << 16, _BASE)
_INVERSE = _powers(1 << 16, pow(_BASE, -1, 2**64))


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept up to the largest n so far."""
    global _POWERS, _INVERSE
    if n > len(_POWERS):
        _POWERS, _INVERSE = _powers(2 * n, _BASE), _powers(2 * n, pow(_BASE, -1, 2**64))
    return _POWERS[:n], _INVERSE[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def selected(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, context hash, context start, context stop, gram place) of the grams that windows select."""
    n = len(text)
    parts = []
    for first in range(0, max(n - LENGTH + 1, 0), SEGMENT):
        # Windows that start in [first, last), with all they and their contexts touch.
        last = min(first + SEGMENT, n - LENGTH + 1)
        low, high = max(0, first - LEFT), min(n, last + LENGTH + LENGTH)
        part = text[low:high]
        up, down = _scales(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_MARKS[part] * up[:-1], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        # Smallest hash of each run of LEFT + 1 grams; the place in the low bits breaks ties to the left.
        least = (grams & ~_U(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= LEFT + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = LEFT + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        places = (least[first - low : last - low] & _U(0xFFFFFF)).astype(np.int64)
        places = places[np.flatnonzero(np.diff(places, prepend=-1))]
        start, stop = np.maximum(places - LEFT, 0), np.minimum(places + LENGTH, len(part))
        whole = (sums[stop] - sums[start]) * down[start]
        shape = ((places - start) * 1000 + (stop - start)).astype(np.uint64)
        parts.append((grams[places], _mixed(whole + shape * _U(0xD6E8FEB86659FD93)), start + low, stop + low, places + low))
    if not parts:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    joined = [np.concatenate(x) for x in zip(*parts)]
    once = np.flatnonzero(np.diff(joined[4], prepend=-1))  # a gram may be selected on both sides of a cut
    return tuple(x[once] for x in joined)


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[new], reach[np.r_[new[1:] - 1, len(start) - 1]]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Selected grams with the first copy of each context of a stretch (anchor >= 0), and the intervals of
    the other copies (anchor -1, dealt by document)."""
    for batch in in_chunks(batches, "text"):
        ids, bodies, found = [], [], []
        for doc_id, text, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            got = selected(np.frombuffer(_bytes(text), dtype=np.uint8))
            if len(got[0]):
                ids.append(np.full(len(got[0]), doc_id, dtype=np.int64))
                bodies.append(np.full(len(got[0]), body, dtype=np.int64))
                found.append(got)
        if not found:
            continue
        doc, text_of = np.concatenate(ids), np.concatenate(bodies)
        h, c, start, stop, place = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, text_of, doc, c, h))
        h, c, doc, text_of, start, stop, place = (x[order] for x in (h, c, doc, text_of, start, stop, place))
        same = np.r_[False, (h[1:] == h[:-1]) & (c[1:] == c[:-1])]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
        # A repeated row is no later copy.
        later = same & ((doc != doc[head]) | (text_of != text_of[head]) | (place != place[head]))
        first = ~same
        by = np.flatnonzero(later & (stop - start >= LENGTH))
        by = by[np.lexsort((start[by], text_of[by], doc[by]))]
        turns = (doc[by][1:] != doc[by][:-1]) | (text_of[by][1:] != text_of[by][:-1])
        edges = np.flatnonzero(np.r_[True, turns]) if len(by) else []
        gone: list[tuple] = []
        for x, y in zip(edges, [*edges[1:], len(by)]):
            a, b = merged(start[by[x:y]], stop[by[x:y]])
            gone.append((np.full(len(a), doc[by[x]]), np.full(len(a), text_of[by[x]]), a, b))
        gd, gt, gs, ge = (np.concatenate(x) for x in zip(*gone)) if gone else (np.zeros(0, np.int64),) * 4
        columns = [
            np.r_[h[first].view(np.int64), _mixed(gd.view(np.uint64) ^ gt.view(np.uint64)).view(np.int64)],
            np.r_[c[first].view(np.int64), np.zeros(len(gd), np.int64)],
            np.r_[doc[first], gd],
            np.r_[text_of[first], gt],
            np.r_[start[first], gs].astype(np.int32),
            np.r_[stop[first], ge].astype(np.int32),
            np.r_[place[first], np.full(len(gd), -1)].astype(np.int32),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "c", "doc_id", "body", "start", "stop", "anchor"])


def previous_factors(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, given in suffix order with the common prefix to the one before.

    A stack holds suffixes of rising place; the one below an entry is its previous smaller place, the one that takes it
    off is its next smaller place, and the common prefixes to both are kept as running minima."""
    out = np.zeros(len(place), dtype=np.int64)
    stack: list[tuple[int, int, int]] = []  # (index, place, common prefix to the entry below)
    for i, p in enumerate([*place.tolist(), -1]):
        common = int(lcp[i]) if 0 < i < len(place) else 0
        while stack and stack[-1][1] > p:
            j, _, below = stack.pop()
            out[j] = max(below, common)
            common = min(common, below)
        stack.append((i, p, common))
    return out


def repeated(key: np.ndarray, doc: np.ndarray, body: np.ndarray, start: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Indices of windows whose text starts earlier in the same bucket.

    ``window`` has a row of LENGTH bytes for each (bucket, doc, body, start); the same place given twice counts once."""
    order = np.lexsort((start, body, doc, key))
    key, doc, body, start, window = key[order], doc[order], body[order], start[order], window[order]
    once = np.r_[
        True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (body[1:] != body[:-1]) | (start[1:] != start[:-1])
    ]
    order, key, window = order[once], key[once], window[once]
    rank = np.cumsum(np.r_[0, key[1:] != key[:-1]]).astype(">u4")
    text = np.concatenate([rank.view(np.uint8).reshape(-1, 4), window], axis=1)
    suffix = np.argsort(np.ascontiguousarray(text).view(f"S{LENGTH + 4}").ravel(), kind="stable")
    lined = text[suffix]
    equal = np.r_[False, (lined[1:] == lined[:-1]).all(axis=1)]
    # Only neighbours with LENGTH bytes in common can give factors that long.
    held = np.flatnonzero(equal | np.r_[equal[1:], False])
    factors = previous_factors(suffix[held], np.where(equal[held], LENGTH, 0))
    return order[suffix[held[factors >= LENGTH]]]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the contexts asked for, as bytes, a row for each long key around the gram."""
    names = ["key", "doc_id", "body", "start", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def out(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types)], names)

    for batch in in_chunks(batches, "text"):
        rows: list[list] = [[] for _ in names]
        for doc_id, text, body, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
            raw = _bytes(text)
            for one in asked:
                at = one["anchor"]
                for a in range(4):
                    left = STEP * a
                    first = max(one["start"], at - (left + STEP - 1 if a < 3 else LEFT))
                    last = min(one["stop"] - LENGTH, at - left)
                    if first > last:
                        continue
                    common = raw[at - left : at + GRAM + STEP * 3 - left]
                    key = int.from_bytes(hashlib.blake2b(common, digest_size=8, salt=b"%d" % a).digest(), "little", signed=True)
                    for column, x in zip(rows, (key, doc_id, body, first, raw[first : last + LENGTH])):
                        column.append(x)
            if len(rows[0]) > 50_000:
                yield out(rows)
                rows = [[] for _ in names]
        if rows[0]:
            yield out(rows)


def _judged(rows: list[tuple]) -> pa.RecordBatch:
    """Repeated windows of whole buckets as intervals; those of crowded buckets that are first in their part, by digest."""
    keys, docs, bodies, starts, views, crowds = [], [], [], [], [], []
    for rank, (_, doc, body, at, raw, crowded) in rows:
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, dtype=np.uint8), LENGTH)
        views.append(view)
        for column, x in zip((keys, docs, bodies, crowds), (rank, doc, body, crowded)):
            column.append(np.full(len(view), x))
        starts.append(np.arange(at, at + len(view)))
    key, doc, body, start, crowded = (np.concatenate(x) for x in (keys, docs, bodies, starts, crowds))
    window = np.concatenate(views)
    order = np.lexsort((start, body, doc))
    key, doc, body, start, crowded, window = (x[order] for x in (key, doc, body, start, crowded, window))
    gone = np.sort(repeated(key, doc, body, start, window))
    # Runs of neighbouring windows become one interval.
    d, t, s = doc[gone], body[gone], start[gone]
    turns = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > s[:-1] + 1)
    new = np.flatnonzero(np.r_[True, turns]) if len(d) else np.zeros(0, int)
    end = np.r_[new[1:] - 1, len(d) - 1] if len(d) else new
    open_ = crowded.copy()
    open_[gone] = False
    left = np.flatnonzero(open_)
    digests = [None] * len(new) + [hashlib.blake2b(window[i].tobytes(), digest_size=16).digest() for i in left]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.r_[d[new], doc[left]], pa.int64()), pa.array(np.r_[t[new], body[left]], pa.int64()),
         pa.array(np.r_[s[new], start[left]].astype(np.int32)),
         pa.array(np.r_[s[end] + LENGTH, start[left] + LENGTH].astype(np.int32)), pa.array(digests, pa.binary())],
        ["doc_id", "body", "start", "stop", "digest"],
    )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, part): sort the windows of whole buckets, some ``WINDOWS`` at a time."""
    held: list[tuple] = []
    count = rank = 0
    before = None
    for batch in batches:
        key, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 6))
        # A row alone in its bucket repeats nothing; the first and last of a batch may have company outside.
        cut = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        alone = np.r_[False, cut] & np.r_[cut, False] & ~batch.column(5).to_numpy(zero_copy_only=False)
        batch = batch.filter(pa.array(~alone))
        for *row, part in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if (row[0], part) != before:
                before = (row[0], part)
                rank += 1
                if count >= WINDOWS:
                    yield _judged(held)
                    held, count = [], 0
            held.append((rank, row))
            count += max(len(row[4]) - LENGTH + 1, 0)
    if held:
        yield _judged(held)


def _bodies(docs: DataFrame) -> DataFrame:
    """doc_id, text and body: the text hash where different texts share a doc_id, else 0, which costs no room."""
    each = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("doc_id"),
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"),
    )
    shared = (
        each.groupBy(F.col("doc_id").alias("s_id"))
        .agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .where("low <> high")
        .select("s_id")
    )
    shared = sized(stored(shared, "shared-ids"))
    return each.join(shared, F.col("doc_id") == F.col("s_id"), "left").select(
        "doc_id", "text", F.when(F.col("s_id").isNotNull(), F.col("body")).otherwise(F.lit(0).cast("bigint")).alias("body")
    )


def intervals(bodies: DataFrame) -> DataFrame:
    """(doc_id, body, start, stop) of removed bytes; intervals may overlap."""
    grams = in_arrow(bodies, _marks, MARKED)
    one_context = Window.partitionBy("h", "c").orderBy("doc_id", "body", "anchor")
    one_gram = Window.partitionBy("h")
    ranked = grams.withColumn("copy", F.rank().over(one_context))
    # rank() leaves repeated rows at 1: they are the same place.
    ranked = ranked.withColumns({"low": F.min("c").over(one_gram), "top": F.max("c").over(one_gram)})
    several = (F.col("anchor") >= 0) & (F.col("copy") == 1) & (F.col("low") != F.col("top"))
    gone = (F.col("anchor") < 0) | (F.col("copy") > 1)
    kept = (
        ranked.where((F.col("stop") - F.col("start") >= LENGTH) & (gone | several))
        .select("doc_id", "body", "start", "stop", "anchor", gone.alias("gone"))
    )
    kept = stored(kept, "contexts")
    asked = (
        kept.where("NOT gone")
        .groupBy(F.col("doc_id").alias("a_id"), F.col("body").alias("a_body"))
        .agg(F.collect_set(F.struct("start", "stop", "anchor")).alias("asked"))
    )
    read = in_arrow(
        bodies.join(asked, (F.col("doc_id") == F.col("a_id")) & (F.col("body") == F.col("a_body")))
        .select("doc_id", "text", "body", "asked"),
        _contexts,
        "key bigint, doc_id bigint, body bigint, start int, bytes binary",
    )
    read = stored(read, "windows")
    crowded = read.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    parts = F.ceil(F.col("n") / F.lit(CROWD))
    dealt = read.join(sized(stored(crowded, "crowded-keys")), F.col("key") == F.col("k"), "left").select(
        *read.columns,
        F.col("n").isNotNull().alias("crowded"),
        F.coalesce(F.pmod(F.xxhash64("doc_id", "body", "start"), parts), F.lit(0)).cast("int").alias("part"),
    )
    dealt = dealt.repartition("key", "part").sortWithinPartitions("key", "part")
    judged = stored(
        dealt.mapInArrow(_suffixes, "doc_id bigint, body bigint, start int, stop int, digest binary"), "judged"
    )
    # Of a window of a crowded bucket each part leaves one copy at most.
    place = F.struct("doc_id", "body", "start")
    left = judged.where("digest IS NOT NULL")
    firsts = left.groupBy(F.col("digest").alias("d")).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = left.join(sized(stored(firsts, "first-windows")), F.col("digest") == F.col("d")).where(place > F.col("first"))
    names = ["doc_id", "body", "start", "stop"]
    return (
        kept.where("gone").select(names)
        .unionByName(judged.where("digest IS NULL").select(names))
        .unionByName(later.select(names))
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text"):
        rows = []
        for doc_id, text, cuts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            raw = _bytes(text)
            start, stop = merged(
                np.array([x["start"] for x in cuts or []], dtype=np.int64), np.array([x["stop"] for x in cuts or []], dtype=np.int64)
            )
            edges = [0, *(x for ab in zip(start.tolist(), stop.tolist()) for x in ab), len(raw)]
            left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((None if doc_id == NULL_ID else doc_id, len(raw), len(raw) - len(left), len(start), left))
        ids, n_bytes, n_removed, n_spans, kept = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes of each row."""
    bodies = _bodies(docs)
    cuts = (
        intervals(bodies)
        .groupBy(F.col("doc_id").alias("c_id"), F.col("body").alias("c_body"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("cuts"))
    )
    own = (F.col("doc_id") == F.col("c_id")) & (F.col("body") == F.col("c_body"))
    joined = bodies.join(cuts, own, "left").select("doc_id", "text", "cuts")
    return in_arrow(joined, _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
