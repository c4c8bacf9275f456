"""Collocations, divergence of sources and language identification against their plain forms."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_DIR
from edge import docs, empty, odd  # noqa: F401
from stayledger.llm import collocations, divergence, language_id
from stayledger.llm.common import read

PROSE = "doc_id bigint, text string, lang string, source string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def prose(n=300, seed=5):
    """Rows with common words, a hot pair, several languages and sources, some of them unknown or empty."""
    rng = random.Random(seed)
    vocabulary = ["new", "york", "the", "of", "été", "ÑU", "東京", "x", "A", "a", "it's", "{b}", "\x00z"]
    marks = [" ", "  ", "\t", ", ", ". ", "\n", "!", " new york "]
    made = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randrange(40)))
        made.append((i, rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", "", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", None, ""])))
    return made + made[:40]


# -- collocations


@pytest.mark.parametrize("held, size", [(1_000_000, 2_000_000), (150, 40)])
def test_collocations(spark, monkeypatch, held, size):
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "STRIDE", 3)
    table = prose()
    df = spark.createDataFrame(table, PROSE).repartition(3)
    for least, top in ((5, 2_000), (12, 7)):
        assert rows(collocations.mine(df, least, top, size)) == brute.phrases([(r[2], r[1]) for r in table], least, top)


def test_cuts_may_go_through_every_prefix(spark):
    """Ranges that begin inside a frequent first word, pair and triple give the same counts."""
    table = prose(120)
    texts = spark.createDataFrame(table, PROSE)
    cuts = collocations.range_cuts(texts.select(F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")), 20)
    assert len(cuts) > 20 and {len(c) for c in cuts} >= {3, 4, 5}
    whole = rows(collocations.phrase_counts(texts, 4, 10**9))
    assert rows(collocations.phrase_counts(texts, 4, 20)) == whole and len(whole) > 50


@pytest.mark.parametrize("given", ["docs", "odd", "empty"])
def test_collocations_of_edge_cases(request, given):
    df = request.getfixturevalue(given)
    table = [tuple(r) for r in df.select("lang", "text").collect()]
    assert rows(collocations.mine(df, 30)) == brute.phrases(table, 30, 2_000)


def test_automata_give_back_and_add_up_their_windows():
    rng = np.random.default_rng(3)
    langs, words = [b"de", b"en"], pa.array([b"a", b"b", b"c"], pa.binary())

    def drawn(n):
        held = rng.integers(0, 4, (n, 5)).astype(np.uint32)
        held[:, 0] %= 2
        held[:, 1] = np.maximum(held[:, 1], 1)
        for k in range(2, 5):
            held[held[:, k - 1] == 0, k] = 0
        return collocations.summed(held, np.ones(n, dtype=np.int64))

    def told(automaton):
        found, weight = automaton.windows()
        return {collocations._path(automaton.langs, automaton.words.to_pylist(), r): int(w) for r, w in zip(found, weight)}

    made = [collocations.build(langs, words, *drawn(n)) for n in (200, 1, 50)]
    copies = [collocations.Automaton.from_bytes(m.to_bytes()) for m in made]
    assert [told(m) for m in made] == [told(c) for c in copies]
    expected = sum((Counter(told(m)) for m in made), Counter())
    both = collocations.union(copies)
    assert told(both) == dict(expected)
    assert int(both.totals()[0][0]) == 251
    prefix = Counter()
    for path, w in expected.items():
        for k in range(1, len(path) + 1):
            prefix[path[:k]] += w
    opened = [(b"en", b"a", b"b", b"c"), (b"de", b"zz")]
    ways = {p[:k] for p in opened for k in range(1, len(p) + 1)}
    expected = {p: w for p, w in prefix.items() if w >= 5 or len(p) == 1 or p in ways}
    assert {(lang, *phrase.split()): w for lang, phrase, _, w in both.prefixes(5, ways)} == expected
    # Cut back, the same prefixes weigh the same.
    short = collocations.union(copies, 5, opened)
    assert {(lang, *phrase.split()): w for lang, phrase, _, w in short.prefixes(5, ways)} == expected
    assert len(short.windows()[0]) < len(both.windows()[0])
    # Equal tails are one state.
    tails = np.array([[0, k, 1, 2, 3] for k in (1, 2, 3)], dtype=np.uint32)
    merged = collocations.build([b"en"], words, tails, np.full(3, 7))
    assert [len(x) for x in merged.label] == [1, 3, 1, 1, 1]


def test_score_products_pass_64_bits(spark):
    a = 4 * 10**15
    counts = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, 3 * a), ("en", "y", 1, a), ("en", "", 0, 9 * a)], "lang string, phrase string, m int, f bigint")
    assert rows(collocations.scored(counts)) == [("en", "x y", a, 3 * a, a, 2_000_000 * a // (4 * a))]


# -- divergence of sources


@pytest.mark.parametrize("block, step, held", [(64, 512, 400_000), (1, 3, 20), (2, 1, 5)])
def test_divergence(spark, monkeypatch, block, step, held):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "STEP", step)
    monkeypatch.setattr(divergence, "HELD", held)
    table = prose()
    df = spark.createDataFrame(table, PROSE).repartition(3)
    expected = brute.divergence([r[1:] for r in table], 10)
    assert {r[2] for r in expected} == {"pair", "term"}
    assert rows(divergence.audit(df)) == expected


@pytest.mark.parametrize("given", ["docs", "odd", "empty"])
@pytest.mark.parametrize("least", [2, 1_000])
def test_divergence_of_edge_cases(request, given, least):
    df = request.getfixturevalue(given)
    table = [tuple(r) for r in df.select("text", "lang", "source").collect()]
    assert rows(divergence.audit(df, least)) == brute.divergence(table, least)


def test_shares_are_exact_beyond_64_bit_products(spark):
    n, total, kept = 7 * 10**15 + 3, 9 * 10**15 + 1, 10**9 + 7
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * kept)


# -- language identification


def test_languages_of_held_out_documents(spark):
    df = read(spark, SF_DIR, "documents")
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    got = language_id.predict(df, language_id.fit(df)).collect()
    assert len(got) == df.count()
    held = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held) and len(held) > 20
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_and_lang_do_not_count(spark):
    df = read(spark, SF_DIR, "documents")
    model = language_id.fit(df)
    other = df.withColumn("lang", F.when(language_id.remainder() == language_id.HELD_OUT, "xx").otherwise(F.col("lang")))
    again = language_id.fit(other)
    assert (again.langs, again.masks.tolist()) == (model.langs, model.masks.tolist())
    assert rows(language_id.predict(df.withColumn("lang", F.lit(None).cast("string")), model)) == rows(language_id.predict(df, model))


@pytest.mark.parametrize("given", ["docs", "odd", "empty"])
def test_language_edge_cases(request, spark, given):
    df = request.getfixturevalue(given)
    got = language_id.predict(df, language_id.fit(df))
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in df.collect())
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in got.collect():
        lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.lang_pred == ("en" if lettered else "und") and (lettered or r.score == 0)
    nobody = language_id.predict(df, language_id.Model())
    assert {r.lang_pred for r in nobody.collect()} <= {"und"}


def test_long_texts_null_ids_and_ties(spark):
    said = {"aa": "abab ", "bb": "cdcd "}
    table = [(i, said[k] * 3, k, "s") for i in range(40) for k in said]
    model = language_id.fit(spark.createDataFrame(table, PROSE))
    odd_rows = [(None, "abab", "bb", None), (1, "cdcd", None, None), (1, "cdcd", None, None), (2, "ABAB " * 4_000_000, None, None), (3, "qqqq", None, None), (4, "12 .", None, None)]
    got = language_id.predict(spark.createDataFrame(odd_rows, PROSE), model)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.lang_pred) for r in got.collect()) == [
        (False, 1, "bb"), (False, 1, "bb"), (False, 2, "aa"), (False, 3, "aa"), (False, 4, "und"), (True, 0, "aa"),
    ]
    assert not any(r.held_out for r in got.collect() if r.doc_id is None)
    # Languages with the same n-grams tie: the first in order is told.
    same = language_id.fit(spark.createDataFrame([(i, "abab", lang, "s") for i in range(40) for lang in ("zz", "mm")], PROSE))
    assert language_id.decide(same, ["abab"])[0] == ["mm"]


def test_filter_names_all_languages_of_a_gram_beyond_one_plane(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    langs = {f"l{i:03d}": letters[i % 26] * 2 + letters[i // 26] * 2 for i in range(130)}
    table = [(i, f"{word} zzzz", lang, "s") for i in range(8) for lang, word in langs.items()]
    df = spark.createDataFrame(table, PROSE)
    model = language_id.fit(df)
    assert len(model.langs) == 130 and len(model.masks) == 3
    gram, size = language_id.grams([language_id.prepared(f"{w} zzzz") for w in langs.values()])
    found = language_id.popcounts(model, gram, size)
    for k, lang in enumerate(langs):
        assert found[k, model.langs.index(lang)] == size[k]  # no gram of its own is missed
    names, _ = language_id.decide(model, list(langs.values()))
    assert names == list(langs)
    shared, one = language_id.grams([b"zzzz"])
    assert (language_id.popcounts(model, shared, one) == 1).all()


def test_grams_stay_within_their_text():
    texts = [b" ab  ", b"", b"xyz", b" abc  "]
    gram, size = language_id.grams(texts)
    expected = [int.from_bytes(t[i : i + 4], "big") for t in texts for i in range(len(t) - 3)]
    assert gram.tolist() == expected and size.tolist() == [max(len(t) - 3, 0) for t in texts]
