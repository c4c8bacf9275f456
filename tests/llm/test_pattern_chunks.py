"""The number of benchmark chunks changes no row of the search."""

from __future__ import annotations

import pytest

from stayledger.llm import decontaminate


@pytest.mark.parametrize("chunk", [100_000, 3])
def test_every_row_comes_back_with_its_own_hits(spark, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK", chunk)
    first, second = "a b c d e f g h i j", "k l m n o p q r s t"
    bench = spark.createDataFrame([(1, first + " u v w"), (2, second + " x y z"), (None, "lone")], "item_id int, text string")
    pairs = [(1, first), (1, second), (1, first), (None, second), (None, first), (None, "a b c d e f g h i k"), (2, ""), (2, "lone")]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    got = [(r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in decontaminate.search(docs, bench).collect()]
    whole = [(0, 10)]
    expected = [(1, 10, whole, ["1"]), (1, 10, whole, ["2"]), (1, 10, whole, ["1"]), (None, 10, whole, ["2"]), (None, 10, whole, ["1"]),
                (None, 10, [], []), (2, 0, [], []), (2, 1, [(0, 1)], [None])]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
