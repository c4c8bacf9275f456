"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

White space is marked as in SentencePiece: one space is put before the text, and every word takes the spaces before it.
No piece spans the end of a word, so words are segmented one by one, each distinct word of a stretch of text once.
The distinct marked words are sorted, which lays them out as a trie in depth-first order: a word keeps the forward
scores of the prefix it shares with the word before and computes only those below.

Scores: the vocabulary file given by default is a merge list without probabilities, so a piece's log probability is taken
from its rank by Zipf's law.  A file with log probabilities is used as it is (``zipf=False``).  A character
that no piece covers costs its UTF-8 bytes, each below the worst piece.  Ties go to the longest last piece.

The marker is kept as a space inside, so a literal marker character in a text is spelled in bytes and
``decode(encode(text)) == text`` holds for every text.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows are encoded each; an
empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stayledger.llm.common import BATCH_ROWS, in_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
# Words kept between stretches of text, per task.
CACHE_WORDS = 200_000
CACHE_CHARS = 64
_WORD = re.compile(r"[ \n]*[^ \n]+|[ \n]+\Z")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space for the marker: {piece: (id, score)}; ids of the 256 bytes; byte score; text of each id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    byte_score: float
    spelled: list[bytes]


def load(path: str = MODEL, zipf: bool = True) -> Vocabulary:
    """Read a SentencePiece file with byte pieces; only its pieces, kinds and scores are used."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled, byte_ids, found = [b""] * sp.get_piece_size(), [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled[i] = bytes([int(piece[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            plain = piece.replace(MARKER, " ")
            spelled[i] = plain.encode()
            found.append((sp.get_score(i), -i, plain))
    found.sort(reverse=True)
    norm = math.log(sum(1 / (r + 2.7) for r in range(len(found))))
    pieces = {p: (-i, -math.log(r + 2.7) - norm if zipf else s) for r, (s, i, p) in enumerate(found)}
    crossing = [p for p in pieces if re.search(r"[^ ][ ]|\n", p)]
    if crossing:
        raise ValueError(f"pieces span words: {crossing[:3]}")
    return Vocabulary(pieces, byte_ids, min(s for _, s in pieces.values()) - 10.0, spelled)


class Segmenter:
    """Best segmentations of sorted words, reusing the scores of shared prefixes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Lengths of the longer pieces by their last three characters, and of all pieces with an ending, longest first.
        self.longer: dict[str, set[int]] = {}
        for piece in vocabulary.pieces:
            if len(piece) > 2:
                self.longer.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths: dict[str, tuple[int, ...]] = {}
        self.word, self.best, self.back = "", [0.0], [(0, -1)]
        self.steps = 0

    def _lengths(self, ending: str) -> tuple[int, ...]:
        """Lengths that a piece at the end of ``ending`` (up to three characters) may have."""
        if len(self.lengths) > CACHE_WORDS:
            self.lengths = {}
        short = [n for n in (2, 1) if len(ending) >= n and ending[-n:] in self.vocabulary.pieces]
        found = self.lengths[ending] = (*sorted(self.longer.get(ending, ()), reverse=True), *short)
        return found

    def encode(self, word: str) -> list[int]:
        v, best, back, last = self.vocabulary, self.best, self.back, self.word
        shared, most = 0, min(len(word), len(last))
        while shared < most and word[shared] == last[shared]:
            shared += 1
        del best[shared + 1 :], back[shared + 1 :]
        get = v.pieces.get
        for end in range(shared + 1, len(word) + 1):
            top, entry = -math.inf, None
            ending = word[end - 3 if end > 3 else 0 : end]
            lengths = self.lengths.get(ending)
            if lengths is None:
                lengths = self._lengths(ending)
            for length in lengths:
                if length <= end:
                    start = end - length
                    hit = get(word[start:end])
                    if hit is not None and best[start] + hit[1] > top:
                        top, entry = best[start] + hit[1], (start, hit[0])
            # Bytes score below any piece, so they matter only where no piece is the last character.
            if not lengths or lengths[-1] != 1:
                spelled = best[end - 1] + v.byte_score * len(word[end - 1].encode())
                if spelled > top:
                    top, entry = spelled, (end - 1, -1)
            best.append(top)
            back.append(entry)
        self.steps += len(word) - shared
        self.word = word
        ids, end = [], len(word)
        while end:
            start, piece = back[end]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(v.byte_ids[b] for b in reversed(word[start:end].encode()))
            end = start
        return ids[::-1]


class Encoder:
    """Texts to ids; ids of words stay as packed 32-bit numbers so that a text's ids are one join of bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.segmenter = Segmenter(vocabulary)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [_WORD.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = set().union(*split).difference(self.known) if split else set()
        ids = {w: array("i", self.segmenter.encode(w)).tobytes() for w in sorted(new)}
        self.known.update(ids)
        out = [b"".join(map(self.known.__getitem__, ws)) for ws in split]
        for w in [w for w in new if len(w) > CACHE_CHARS]:
            del self.known[w]
        return out


def decode_ids(ids: list[int], spelled: list[bytes]) -> str:
    joined = b"".join(map(spelled.__getitem__, ids))
    return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def _batches(df: DataFrame) -> None:
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column of piece ids."""
    schema, at = _extended(docs, ids, T.ArrayType(T.IntegerType(), False)), docs.columns.index(text)
    v = vocabulary
    shared = docs.sparkSession.sparkContext.broadcast((v.pieces, v.byte_ids, v.byte_score, v.spelled))
    _batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            for part in in_chunks([batch], batch.schema.names[at]):
                packed = encoder.encode(part.column(at).to_pylist())
                offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"), pa.int32())
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids."""
    schema, at = _extended(rows, text, T.StringType()), rows.columns.index(ids)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.spelled)
    _batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = shared.value
        for batch in batches:
            lists = batch.column(at)
            values = lists.values.to_numpy(zero_copy_only=False) if len(lists.values) else np.zeros(0, np.int32)
            cuts = lists.offsets.to_numpy()
            texts = [decode_ids(values[a:b].tolist(), spelled) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return rows.mapInArrow(run, schema)
