"""Phrases of two to four words that occur together more often than their parts would suggest, per language.

Every word opens a window: its language, the word and up to three words after it within the piece.  The number of
occurrences of a phrase is the number of windows that begin with it, so one automaton over windows counts all lengths.

1. A task sorts the windows of a stretch of text and builds a weighted acyclic automaton from them for each prefix range:
   states are made from the tails up, equal ones are merged, and the arcs into the last level carry the counts.
2. Ranges are cut by whole windows, drawn from a sample of the texts, so a frequent first word spreads over many ranges.  The
   automata of a range meet in one task, their union sums the weights, and its states give the weight of every prefix.
   Windows are cut back to the last prefix that occurs often enough first, as nothing longer can be a phrase.
   A phrase that lies within the range is final, and kept from ``LEAST`` occurrences on; one that a cut goes through is handed
   on in parts, at most eight a range, and summed by Spark.
3. Parts are looked up by composing the phrases with the sorted table of phrase weights, an equi-join on (lang, phrase); as many
   phrases share a one-word part, those lookups are salted.

Parts and longer phrases of a candidate are at least as frequent as it is (or count only if they are), so nothing below ``LEAST``
is ever asked for.  Sums are 64-bit integers, products and quotients decimals of 38 digits.

Defined results: a null lang counts as ``und``; null and empty texts have no words; repeated rows count each; ties are settled by
count, then phrase; a language with fewer candidates gives fewer rows; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import in_arrow, in_chunks, sized, stored

LEAST = 30
WORDS = 4
DEPTH = WORDS + 1
TOP = 2_000
ABSORBED = 80
# Windows a task holds before it builds its automata, and windows a range is meant to have.
HELD = 1_000_000
RANGE = 1_000_000
# Sampled windows per range, and how many windows of a sampled text are passed over between two.
DRAWN, STRIDE = 50, 64
# Copies of a one-word part in the lookup.
SALTS = 16
_BREAK = b"\n"
_CUT = bytes(10 if chr(b) in ".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

PHRASES = "lang string, phrase binary, m int, f bigint"


@dataclass
class Automaton:
    """Arcs level by level: those of state s of a level are ``offset[s]:offset[s + 1]``; the last level's targets are weights.

    Labels of the first level count ``langs``, those of the others ``words`` from 1; 0 ends a window early."""

    langs: list[bytes]
    words: pa.BinaryArray
    offset: list[np.ndarray]
    label: list[np.ndarray]
    target: list[np.ndarray]

    def totals(self) -> list[np.ndarray]:
        """Weight of all windows from each state on, per level."""
        out: list[np.ndarray] = [None] * DEPTH
        below = None
        for level in reversed(range(DEPTH)):
            arcs = self.target[level] if below is None else below[self.target[level]]
            below = out[level] = np.add.reduceat(arcs, self.offset[level][:-1]) if len(arcs) else np.zeros(0, np.int64)
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """All windows in order, as labels, and their weights."""
        state = np.zeros(1 if len(self.offset[0]) > 1 else 0, dtype=np.int64)
        columns: list[np.ndarray] = []
        for level in range(DEPTH):
            origin, arc = self._arcs(level, state)
            columns = [c[origin] for c in columns] + [self.label[level][arc]]
            state = self.target[level][arc]
        return np.stack(columns, axis=1), state

    def _arcs(self, level: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the state, arc) for all arcs of the states."""
        first, degree = self.offset[level][state], self.offset[level][state + 1] - self.offset[level][state]
        origin = np.repeat(np.arange(len(state)), degree)
        before = np.cumsum(degree) - degree
        return origin, first[origin] + np.arange(len(origin)) - before[origin]

    def prefixes(self, least: int, opened: set[tuple]) -> Iterator[tuple[bytes, bytes, int, int]]:
        """(lang, phrase, words, weight) of the prefixes from ``least`` on, and of all those in ``opened`` and of no word."""
        total = self.totals()
        state, paths = np.zeros(1 if len(self.offset[0]) > 1 else 0, dtype=np.int64), [()]
        for level in range(DEPTH):
            origin, arc = self._arcs(level, state)
            label, target = self.label[level][arc], self.target[level][arc]
            weight = target if level == DEPTH - 1 else total[level + 1][target]
            # Only prefixes worth a further look become Python objects; open ones come from few paths.
            wide = np.array([level == 0 or p in opened for p in paths], dtype=bool)
            look = np.flatnonzero(((weight >= least) | wide[origin]) & ((label > 0) | (level == 0)))
            kept, onward = [], []
            for k in look.tolist():
                word = self.langs[label[k]] if level == 0 else self.words[int(label[k]) - 1].as_py()
                path = (*paths[origin[k]], word)
                if level == 0 or weight[k] >= least or path in opened:
                    yield path[0], b" ".join(path[1:]), level, int(weight[k])
                    kept.append(k), onward.append(path)
            state, paths = target[np.array(kept, dtype=np.int64)], onward

    def to_bytes(self) -> bytes:
        sink = pa.BufferOutputStream()
        arrays = [
            pa.array(self.langs, pa.binary()),
            self.words,
            *(pa.array(_narrow(x)) for level in range(DEPTH) for x in (np.diff(self.offset[level]), self.label[level], self.target[level])),
        ]
        fields = [pa.field(str(k), a.type) for k, a in enumerate(arrays)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays]
        batch = pa.RecordBatch.from_arrays(lists, schema=pa.schema([pa.field(f.name, x.type) for f, x in zip(fields, lists)]))
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def from_bytes(raw: bytes) -> Automaton:
        columns = [c.values for c in pa.ipc.open_stream(raw).read_next_batch().columns]
        arcs = [c.to_numpy(zero_copy_only=False) for c in columns[2:]]
        offset = [np.r_[0, np.cumsum(x, dtype=np.int64)] for x in arcs[::3]]
        label = [x.astype(np.uint32) for x in arcs[1::3]]
        return Automaton(columns[0].to_pylist(), columns[1], offset, label, [x.astype(np.int64) for x in arcs[2::3]])


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _merged(first: np.ndarray, label: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each state after merging equal ones, index of a state per number).  States are the runs of arcs
    that begin at ``first``; they are equal if all their arcs are."""
    # Weights may be large; states are numbered from 0.
    code = target if len(target) and target.max() < 1 << 32 else np.unique(target, return_inverse=True)[1]
    arc = (label.astype(np.uint64) << np.uint64(32)) | code.astype(np.uint64)
    degree = np.diff(np.r_[first, len(label)])
    number = np.empty(len(first), dtype=np.int64)
    single = np.flatnonzero(degree == 1)
    _, shown, inverse = np.unique(arc[first[single]], return_index=True, return_inverse=True)
    number[single] = inverse
    kept = [single[shown]]
    register: dict[bytes, int] = {}
    raw, several = arc.tobytes(), np.flatnonzero(degree > 1)
    new = []
    for s, a, b in zip(several.tolist(), (first[several] * 8).tolist(), ((first[several] + degree[several]) * 8).tolist()):
        arcs = raw[a:b]
        known = register.get(arcs)
        if known is None:
            known = register[arcs] = len(shown) + len(new)
            new.append(s)
        number[s] = known
    kept.append(np.array(new, dtype=np.int64))
    return number, np.concatenate(kept)


def build(langs: list[bytes], words: pa.BinaryArray, rows: np.ndarray, weight: np.ndarray) -> Automaton:
    """The minimal automaton of sorted distinct windows."""
    offset, labels, targets = ([None] * DEPTH for _ in range(3))
    target = weight.astype(np.int64)
    for level in reversed(range(DEPTH)):
        label = rows[:, level]
        turns = (rows[1:, :level] != rows[:-1, :level]).any(axis=1) if level else np.zeros(max(len(rows) - 1, 0), dtype=bool)
        first = np.flatnonzero(np.r_[True, turns]) if len(rows) else np.zeros(0, dtype=np.int64)
        number, kept = _merged(first, label, target)
        degree = np.diff(np.r_[first, len(label)])[kept]
        offset[level] = np.r_[0, np.cumsum(degree)]
        before = offset[level][:-1]
        origin = np.repeat(np.arange(len(kept)), degree)
        arc = first[kept][origin] + np.arange(len(origin)) - before[origin]
        labels[level], targets[level] = label[arc], target[arc]
        rows, target = rows[first], number
    return Automaton(langs, words, offset, labels, targets)


def _order(rows: np.ndarray) -> np.ndarray:
    """Sort order of windows: two packed keys (4,096 languages and 2^26 words at a time)."""
    r = rows.astype(np.uint64)
    return np.lexsort((r[:, 3] << np.uint64(32) | r[:, 4], r[:, 0] << np.uint64(52) | r[:, 1] << np.uint64(26) | r[:, 2]))


def summed(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows and their weights."""
    order = _order(rows)
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, dtype=np.int64)
    return rows[first], np.add.reduceat(weight[order], first) if len(rows) else weight


def cut_back(rows: np.ndarray, weight: np.ndarray, least: int, opened: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows without the words after the last prefix that weighs ``least``, or lies on the way to one of the
    ``opened`` windows (labels, 0 where the window ends).  Weights of all prefixes that weigh as much stay what they are."""
    if not len(rows):
        return rows, weight
    rows = rows.copy()
    kept = np.ones(len(rows), dtype=bool)
    turns = rows[1:, 0] != rows[:-1, 0]
    same = [rows[:, 0] == path[0] for path in opened]
    for level in range(1, DEPTH):
        turns = turns | (rows[1:, level] != rows[:-1, level])
        first = np.flatnonzero(np.r_[True, turns])
        often = np.repeat(np.add.reduceat(weight, first) >= least, np.diff(np.r_[first, len(rows)]))
        for k, path in enumerate(opened):
            same[k] = same[k] & (rows[:, level] == path[level]) & (path[level] > 0)
            often = often | same[k]
        kept &= often
        rows[~kept, level] = 0
    return summed(rows, weight)


def union(parts: list[Automaton], least: int = 1, opened: list[tuple] = ()) -> Automaton:
    """The automaton of all windows, weights summed; windows are cut back to prefixes of ``least`` weight or in ``opened``."""
    langs = sorted({x for p in parts for x in p.langs})
    lang_at = {x: k for k, x in enumerate(langs)}
    each = pa.concat_arrays([p.words for p in parts])
    words = pc.unique(each)
    words = words.take(pc.sort_indices(words))
    place = pc.index_in(each, value_set=words).to_numpy(zero_copy_only=False).astype(np.uint32) + np.uint32(1)
    rows, weights, begin = [], [], 0
    for p in parts:
        mine, weight = p.windows()
        lang = np.array([lang_at[x] for x in p.langs], dtype=np.uint32)
        word = np.concatenate([np.zeros(1, np.uint32), place[begin : begin + len(p.words)]])
        begin += len(p.words)
        rows.append(np.column_stack([lang[mine[:, 0]], word[mine[:, 1:]]]))
        weights.append(weight)
    rows, weight = summed(np.concatenate(rows), np.concatenate(weights))
    if least > 1:
        paths = np.zeros((len(opened), DEPTH), dtype=np.int64)
        for k, (lang, *rest) in enumerate(opened):
            found = pc.index_in(pa.array(rest, pa.binary()), value_set=words).to_pylist()
            paths[k, 0] = lang_at.get(lang, -1)
            paths[k, 1 : 1 + len(rest)] = [-1 if x is None else x + 1 for x in found]
        rows, weight = cut_back(rows, weight, least, paths)
    return build(langs, words, rows, weight)


class Stretch:
    """Windows of some texts, with words numbered as they come."""

    def __init__(self) -> None:
        counter = count(2)
        self.number: dict[bytes, int] = defaultdict(lambda: next(counter))
        self.number[b""], self.number[_BREAK] = 0, 1
        self.langs: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.of: list[tuple[int, int]] = []
        self.size = 0

    def add(self, lang: bytes, raw: bytes) -> None:
        tokens = raw.translate(_CUT).replace(_BREAK, b" \n ").split(b" ")
        ids = np.fromiter(map(self.number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        ids = ids[ids > 0]
        self.parts.append(np.append(ids, 1))
        self.of.append((self.langs.setdefault(lang, len(self.langs)), len(ids) + 1))
        self.size += len(ids)

    def windows(self) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """Sorted languages, sorted words, and a row per word occurrence."""
        langs, words = sorted(self.langs), sorted(w for w, k in self.number.items() if k > 1)
        rank = np.zeros(len(self.number), dtype=np.uint32)
        rank[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
        lang_rank = np.zeros(len(langs), dtype=np.uint32)
        lang_rank[[self.langs[x] for x in langs]] = np.arange(len(langs))
        ids = rank[np.concatenate([*self.parts, np.ones(WORDS, dtype=np.int64)])] if self.parts else np.zeros(WORDS, np.uint32)
        n = len(ids) - WORDS
        rows = np.zeros((n, DEPTH), dtype=np.uint32)
        if self.of:
            rows[:, 0] = np.repeat(lang_rank[[k for k, _ in self.of]], [m for _, m in self.of])
        within = np.ones(n, dtype=bool)
        for k in range(WORDS):
            within &= ids[k : n + k] > 0
            rows[:, k + 1] = np.where(within, ids[k : n + k], 0)
        return langs, words, rows[rows[:, 1] > 0]


def _path(langs: list[bytes], words: list[bytes], row: np.ndarray) -> tuple:
    return (langs[row[0]], *(words[k - 1] for k in row[1:] if k))


def _ranges(cuts: list[tuple]):
    """lang, text -> prefix range and the automaton of the range's windows in a stretch of text."""

    def built(held: Stretch) -> Iterator[pa.RecordBatch]:
        langs, words, rows = held.windows()
        rows, weight = summed(rows, np.ones(len(rows), dtype=np.int64))
        edges = [bisect_left(range(len(rows)), c, key=lambda i: _path(langs, words, rows[i])) for c in cuts]
        for k, (a, b) in enumerate(zip([0, *edges], [*edges, len(rows)])):
            if a < b:
                used, mine = np.unique(rows[a:b, 1:], return_inverse=True)
                mine = mine.reshape(-1, WORDS) + (0 if used[0] == 0 else 1)
                own = pa.array([words[w - 1] for w in used if w], pa.binary())
                made = build(langs, own, np.column_stack([rows[a:b, 0], mine]), weight[a:b])
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([made.to_bytes()], pa.binary())], ["at", "automaton"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stretch()
        for batch in in_chunks(batches, "text"):
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.add(lang, raw)
                if held.size >= HELD or len(held.langs) >= 4_000:
                    yield from built(held)
                    held = Stretch()
        if held.size:
            yield from built(held)

    return run


def _unions(cuts: list[tuple], least: int):
    """Rows sorted by range -> weights of the phrases of each range."""

    def told(at: int, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        around = [c for c in (cuts[at - 1 : at] if at else []) + cuts[at : at + 1]]
        opened = {c[:k] for c in around for k in range(1, len(c) + 1)}
        found = list(union([Automaton.from_bytes(p) for p in parts], least, around).prefixes(least, opened))
        lang, phrase, m, f = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.decode() for x in lang], pa.string()), pa.array(phrase, pa.binary()), pa.array(m, pa.int32()), pa.array(f, pa.int64())],
            ["lang", "phrase", "m", "f"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if at != now and parts:
                    yield from told(now, parts)
                    parts = []
                now = at
                parts.append(raw.as_py())
        if parts:
            yield from told(now, parts)

    return run


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every ``STRIDE``-th window of the given texts."""
    for batch in in_chunks(batches, "text"):
        held = Stretch()
        for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.add(lang, raw)
        langs, words, rows = held.windows()
        paths = [_path(langs, words, row) for row in rows[::STRIDE]]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.list_(pa.binary()))], ["path"])


def range_cuts(texts: DataFrame, size: int = RANGE) -> list[tuple]:
    """Windows that cut all windows into ranges of about ``size``; one for each ``size``, so few beside the texts."""
    total = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    ranges = -(-total // size)
    if ranges < 2:
        return []
    part = min(1.0, ranges * DRAWN * STRIDE / total)
    some = texts.where(F.pmod(F.xxhash64(F.lit("window sample"), "text"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
    paths = in_arrow(some, _drawn, "path array<binary>").toArrow()["path"].to_pylist()
    paths = sorted(map(tuple, paths))
    return sorted({paths[len(paths) * k // ranges] for k in range(1, ranges)}) if paths else []


def phrase_counts(docs: DataFrame, least: int = LEAST, size: int = RANGE) -> DataFrame:
    """lang, phrase, m words, f occurrences, for phrases of up to four words from ``least`` on; m = 0: all words of the language."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    cuts = range_cuts(texts, size)
    ranges = in_arrow(texts, _ranges(cuts), "at int, automaton binary")
    placed = ranges.repartition("at").sortWithinPartitions("at")
    parts = in_arrow(placed, _unions(cuts, least), PHRASES).withColumn("phrase", F.col("phrase").cast("string"))
    whole = parts.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f"))
    return whole.where((F.col("f") >= least) | (F.col("m") == 0))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _joined(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of every candidate, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cut = counts.where("m > 1").select("lang", "phrase", F.col("f").alias("a"), "m", words.alias("ws"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))

    def salted(part: Column, m: Column) -> Column:
        return F.when(m == 1, F.pmod(F.xxhash64("phrase", "k"), F.lit(SALTS)).cast("int")).otherwise(0)

    cut = cut.withColumns({"head": _joined(F.col("ws"), 1, F.col("k")), "tail": _joined(F.col("ws"), F.col("k") + 1, F.col("m") - F.col("k"))})
    cut = cut.withColumns({"head_salt": salted(F.col("head"), F.col("k")), "tail_salt": salted(F.col("tail"), F.col("m") - F.col("k"))}).drop("ws")
    weights = counts.where("m BETWEEN 1 AND 3").select(
        F.col("lang").alias("w_lang"), F.col("phrase").alias("part"), F.col("f").alias("weight"),
        F.explode(F.when(F.col("m") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"),
    )
    weights = sized(weights)
    for side, name in (("head", "l"), ("tail", "r")):
        found = (F.col("lang") == F.col("w_lang")) & (F.col(side) == F.col("part")) & (F.col(f"{side}_salt") == F.col("salt"))
        cut = cut.join(weights, found).drop("w_lang", "part", "salt").withColumnRenamed("weight", name)
    score = _div(F.lit(2_000_000).cast("decimal(7,0)") * _wide(F.col("a")), _wide(F.col("l")) + _wide(F.col("r"))).cast("bigint")
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def absorbed(counts: DataFrame) -> DataFrame:
    """lang, phrase, top: phrases inside longer ones, with the highest count of such."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("m") - s + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, s), " "))))
    return counts.where("m > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("top"))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, size: int = RANGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    counts = stored(phrase_counts(docs, least, size), "phrase-counts")
    covered = F.lit(100).cast("decimal(3,0)") * _wide(F.col("top")) >= F.lit(ABSORBED).cast("decimal(3,0)") * _wide(F.col("a"))
    left = (
        scored(counts)
        .join(absorbed(counts), ["lang", "phrase"], "left")
        .where(F.col("top").isNull() | ~covered)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))))
        .where(F.col("rank") <= top)
    )
    n = sized(counts.where("m = 0").select("lang", F.col("f").alias("n")))
    return left.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
