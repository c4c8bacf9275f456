"""Rows without a doc_id of their own: null doc_ids, and one doc_id with different texts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import brute
import corpus_pipeline
from stayledger.llm import decontaminate, line_rules, longest_previous, pieces, simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _text(seed: int, words: int = 80) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(words))


def _docs(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in pairs], COLUMNS)


def _texts(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in df.collect())


def test_keep_one_keeps_a_row_of_every_group(spark):
    a, b, c, d, e = (_text(k) for k in range(5))
    df = _docs(spark, [(None, a), (None, b), (None, a), (7, c), (7, d), (7, c), (None, e), (3, e)])
    assert _texts(simhash.keep_one(df)) == sorted([(True, 0, a), (True, 0, b), (False, 7, c), (False, 7, d), (False, 3, e)])


def test_clean_takes_contaminated_texts_only(spark):
    item = _text(50, 12)
    bad, one, two = _text(1) + " " + item, _text(2), _text(3)
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    df = _docs(spark, [(None, bad), (None, one), (4, two), (4, bad)])
    assert _texts(decontaminate.clean(df, bench)) == sorted([(True, 0, one), (False, 4, two)])


def test_cuts_stay_with_their_text(spark, monkeypatch):
    shared = _text(9, 40)
    texts = [_text(10, 60) + shared, shared + _text(11, 60), _text(12, 90), _text(13, 30) + shared + _text(14, 30)]
    for crowd in (5_000, 1):
        monkeypatch.setattr(longest_previous, "CROWD", crowd)
        for ids in ([5, 5, 5, 5], [None] * 4, [None, 5, 5, None]):
            df = _docs(spark, list(zip(ids, texts)))
            hashes = [r[0] for r in df.select(F.xxhash64("text")).collect()]
            order = sorted(range(4), key=lambda k: (ids[k] is not None, ids[k] or 0, hashes[k]))
            expected = brute.repeats({n: texts[k] for n, k in enumerate(order)})
            got = longest_previous.remove_repeats(df).withColumn("sha", F.sha2("kept", 256)).collect()
            assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got) == sorted(expected.values())


def test_pipeline_keeps_what_brute_force_keeps(spark, tmp_path):
    item = _text(99, 12)
    texts = [_text(200 + k) for k in range(30)]
    pairs = [(None, t) for t in texts[:12]] + [(1, t) for t in texts[12:20]] + [(10 + k, t) for k, t in enumerate(texts[20:])]
    pairs += [(None, texts[0]), (2, texts[25]), (None, _text(300) + " " + item), (1, _text(301) + " " + item), (None, "too short")]
    _docs(spark, pairs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = [(i, "s", t) for i, t in pairs]
    verdict = brute.depleted(table, line_rules.MIN_DOCS, line_rules.SHARE, line_rules.KEEP)
    passed = [(i, t) for (i, _, t), v in zip(table, verdict) if v[1]]
    marks = {k: brute.simhash(t) for k, (_, t) in enumerate(passed)}
    label = brute.groups(marks)
    kept = []
    for g in set(label.values()):
        kept.append(min((passed[k] for k in label if label[k] == g), key=lambda x: (x[0] is None, x[0] or 0)))
    expected = sorted((i is None, i or 0, t) for i, t in kept if not brute.hits(t, {1: item})[-1])
    vocabulary = pieces.load()
    out = pieces.decode(corpus_pipeline.run(spark, str(tmp_path)), vocabulary)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in out.collect()) == expected
