"""Each text operator against its plain form, on edge cases; copies, hot groups, empty tables, clashing columns."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from edge import docs, empty, odd  # noqa: F401
from stayledger.llm import (
    components,
    decontaminate,
    html_blocks,
    line_rules,
    longest_previous,
    pieces,
    pii,
    rule_ensemble,
    secrets,
    severity,
    simhash,
)
from stayledger.llm.common import listed


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def both(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_line_rules(request, given):
    df = request.getfixturevalue(given)
    table = [tuple(r) for r in df.select("doc_id", "source", "text").collect()]
    limits = {"min_docs": 1, "share": 0.3}
    verdict = brute.depleted(table, 1, 0.3, line_rules.KEEP)
    expected = sorted((t[0], *brute.quality(t[2]), v[1]) for t, v in zip(table, verdict))
    judged = line_rules.judge(df, **limits)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert both(judged, *names) == expected
    cleaned = line_rules.clean(df, **limits)
    assert cleaned.columns == df.columns
    kept = sorted(
        (t[0], "\n".join(x for i, x in enumerate(t[2].split("\n")) if i not in v[0]))
        for t, v in zip(table, verdict)
        if v[1]
    )
    assert both(cleaned, "doc_id", "text") == kept


def test_frequent_lines_need_both_limits_and_distinct_texts(spark):
    shared = "a line that many share"
    tail = " ".join(f"w{i}" for i in range(60))
    data = [(i, f"{shared}\n{tail} n{i}", "h", None) for i in range(6)] + [(10 + i, f"only copies here\n{tail}", "h", None) for i in range(6)]
    df = spark.createDataFrame(data, "doc_id int, text string, source string, lang string")
    often = line_rules.frequent_lines(df, min_docs=5, share=0.5)
    assert [r["n_texts"] for r in often.collect()] == [6]
    assert not line_rules.frequent_lines(df, min_docs=6, share=0.5).count()
    assert line_rules.clean(df.withColumn("n_chars", F.lit(0)), min_docs=5, share=0.5).where(F.contains("text", F.lit(shared))).count() == 0


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_secrets(request, given):
    df = request.getfixturevalue(given)
    expected = sorted((r["doc_id"], brute.spans(brute.secrets(r["text"]))) for r in df.select("doc_id", "text").collect())
    found, _ = secrets.findings(df)
    assert both(found.select("doc_id", listed(F.col("spans")).alias("s")), "doc_id", "s") == expected
    clean = secrets.redact(df)
    assert clean.columns == df.columns
    assert clean.count() == df.count()
    assert not [r for r in clean.collect() if brute.secrets(r["text"])]


def test_secret_scan_reads_only_what_the_ledger_lacks(spark, docs):
    _, ledger = secrets.findings(docs)
    assert secrets.scan(docs, ledger).count() == 0
    more = docs.unionByName(spark.createDataFrame([(900, "token = abcdefghijklmnop", "en", "s", 1)], docs.schema))
    new = secrets.scan(more, ledger)
    assert {(r["kind"], len(r["spans"])) for r in new.collect()} == {("assign", 1), ("access", 0), ("hex", 0)}
    # A raised version of one rule is due for every blob, the others are not.
    old = ledger.withColumn("version", F.when(F.col("kind") == "hex", 0).otherwise(F.col("version")))
    assert {r["kind"] for r in secrets.scan(docs, old).select("kind").distinct().collect()} == {"hex"}
    again, _ = secrets.findings(docs, ledger)
    first, _ = secrets.findings(docs)
    assert both(again.select("doc_id", listed(F.col("spans")).alias("s")), "doc_id", "s") == both(
        first.select("doc_id", listed(F.col("spans")).alias("s")), "doc_id", "s"
    )


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_pii_base(request, given):
    df = request.getfixturevalue(given)
    expected = sorted((r["doc_id"], brute.spans(brute.pii(r["text"]))) for r in df.select("doc_id", "text").collect())
    found, _ = pii.find(df)
    assert both(found.select("doc_id", listed(F.col("base")).alias("s")), "doc_id", "s") == expected


def test_terms_that_disclose_an_entity(spark):
    plain = [(i, f"ordinary report number {i} about nothing in particular", None) for i in range(40)]
    told = [(100 + i, f"case {i} where Quillfeather wrote from q@ex.org about report", None) for i in range(4)]
    df = spark.createDataFrame(plain + told, "doc_id int, text string, n_chars int")
    found, terms = pii.find(df)
    flagged = {r["term"]: r["disclosure"] for r in terms.collect()}
    assert flagged["quillfeather"] == pytest.approx(1.0)
    assert "report" not in flagged
    assert all("term" not in {s["kind"] for s in r["spans"]} for r in found.where("doc_id < 100").collect())
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "Quillfeather" not in out[100] and "[EMAIL]" in out[100] and out[3] == plain[3][1]
    # Two texts are no evidence, nor are copies of one.
    assert pii.find(df.where("doc_id < 102"))[1].count() == 0
    copies = df.where("doc_id < 101").unionByName(df.where("doc_id = 100").withColumn("doc_id", F.lit(7000)))
    assert pii.find(copies)[1].count() == 0


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_simhash(request, given):
    df = request.getfixturevalue(given)
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    fps = {i: brute.simhash(t) for i, t in texts.items()}
    label = brute.groups(fps)
    got = simhash.near_duplicates(df).select("doc_id", simhash.hex_digits().alias("f"), "component_id")
    assert set(both(got, "doc_id", "f", "component_id")) == {(i, f"{fps[i]:016x}", label[i]) for i in texts}
    one = simhash.keep_one(df)
    assert one.columns == df.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(label.values()))


def test_simhash_links_of_crowded_lists(spark, monkeypatch):
    """Near fingerprints in great number, in whole lists and in pairs of blocks, give the same components."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(40)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    label = brute.groups({x: x & (1 << 64) - 1 for x in signed})
    for block in (20_000, 3):
        monkeypatch.setattr(simhash, "BLOCK", block)
        roots = dict(rows(components.components(simhash.links(df))))
        assert {x: roots.get(x, x) for x in signed} == label


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 60), (60, 50), (70, 70), (61, 60)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert got == {**{i: 0 for i in range(1, 31)}, 60: 50, 61: 50}


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_decontamination(request, spark, given, monkeypatch):
    df = request.getfixturevalue(given)
    items = {1: "GAMMA delta-epsilon zeta, eta theta iota kappa lambda mu nu", 2: "two three", 3: None, 4: "!!", 5: "東京 été",
             6: " ".join(f"w{i * i % 977} q{i % 31}" for i in range(40, 60)), 7: "one"}
    bench = spark.createDataFrame(list(items.items()), "item_id int, text string")
    texts = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    expected = sorted((i, *brute.hits(t, items)) for i, t in texts)

    def got(found):
        return both(
            found.select(
                "doc_id", "n_words", decontaminate.n_hit().alias("n"), F.size("items").alias("k"),
                F.sha2(F.array_join("items", ","), 256).alias("s"), (F.size("spans") > 0).alias("x"),
            ),
            "doc_id", "n_words", "n", "k", "s", "x",
        )

    assert got(decontaminate.search(df, bench)) == expected
    monkeypatch.setattr(decontaminate, "CHUNK", 1)  # several chunks of patterns
    assert got(decontaminate.search(df, bench)) == expected
    clean = decontaminate.clean(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {x[0] for x in expected if not x[-1]}
    assert decontaminate.clean(df, bench.limit(0)).count() == df.count()


@pytest.mark.parametrize("given", ["docs", "odd"])
@pytest.mark.parametrize("crowd", [5_000, 1])
def test_repeated_passages(request, given, crowd, monkeypatch):
    monkeypatch.setattr(longest_previous, "CROWD", crowd)
    df = request.getfixturevalue(given)
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    expected = brute.repeats(texts)
    got = longest_previous.remove_repeats(df).withColumn("sha", F.sha2("kept", 256))
    names = ["n_bytes", "n_removed", "n_spans", "sha"]
    found = [(r["doc_id"], tuple(r[n] for n in names)) for r in got.collect()]
    assert len(found) == df.count()
    assert {i: x for i, x in found} == expected


def test_repeated_passages_at_random(spark):
    """Pieces of few kinds put together at random: many grams with several contexts."""
    rng = random.Random(11)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 140))) for _ in range(12)]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = longest_previous.remove_repeats(df).withColumn("sha", F.sha2("kept", 256)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got} == brute.repeats(texts)


def test_long_texts_are_cut_into_segments(monkeypatch):
    text = np.frombuffer(("ab" * 50 + "".join(f"{i * i % 991:x}" for i in range(3_000)) * 2).encode(), dtype=np.uint8)
    whole = longest_previous.selected(text)
    monkeypatch.setattr(longest_previous, "SEGMENT", 500)
    for a, b in zip(whole, longest_previous.selected(text)):
        assert (a == b).all()


def test_previous_factors():
    text = "abaababaab"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(i, j):
        n = 0
        while i + n < len(text) and j + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    lcp = [0, *(common(order[i - 1], order[i]) for i in range(1, len(order)))]
    got = longest_previous.previous_factors(np.array(order), np.array(lcp))
    assert {p: f for p, f in zip(order, got)} == {p: max([common(p, q) for q in range(p)], default=0) for p in range(len(text))}


def test_piece_round_trip(spark, odd):
    vocabulary = pieces.load()
    coded = pieces.decode(pieces.encode(odd.select("doc_id", "text", "fp"), vocabulary), vocabulary)
    for r in coded.collect():
        assert r["decoded"] == (r["text"] or "")
    with pytest.raises(ValueError):
        pieces.encode(odd.withColumn("ids", F.lit(1)), vocabulary)


def test_pieces_are_the_best_and_prefixes_are_shared():
    vocabulary = pieces.load()

    def best(text):
        """All segmentations of a short word by recursion."""
        memo = {"": (0.0, 0)}

        def rest(t):
            if t not in memo:
                options = [(vocabulary.pieces[t[:k]][1] + rest(t[k:])[0], 0) for k in range(1, len(t) + 1) if t[:k] in vocabulary.pieces]
                options.append((vocabulary.byte_score * len(t[0].encode()) + rest(t[1:])[0], 0))
                memo[t] = max(options)
            return memo[t]

        return rest(text)[0]

    score = {i: s for i, s in vocabulary.pieces.values()} | {i: vocabulary.byte_score for i in vocabulary.byte_ids}
    words = sorted([" international", " internationally", " interning", " ▁mark", " 東京x", "  two", " ", " 😀a", " zzzqqq", "\n\n the"])
    segmenter = pieces.Segmenter(vocabulary)
    for word in words:
        ids = segmenter.encode(word)
        assert b"".join(vocabulary.spelled[i] for i in ids).decode() == word
        assert sum(score[i] for i in ids) == pytest.approx(best(word))
    assert segmenter.steps < sum(map(len, words))


def test_rule_ensemble(spark, odd):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["the", "of", "river", "stone", "light"]) + str(rng.randint(0, 99)) for _ in range(80)), 1) for i in range(300)]
    bad = [(1000 + i, "BUY!! NOW!! " * 40, 0) for i in range(100)]
    df = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in good + bad] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in rule_ensemble.score(df, labels).collect()}
    assert all(got[i]["predicted"] == y for i, _, y in good + bad)
    assert any(r["held_out"] for r in got.values()) and all(0 <= r["score"] <= 1 for r in got.values())
    edge = rule_ensemble.score(odd, labels)
    assert edge.count() == odd.count() and not edge.where("score is null or predicted is null").count()
    assert {r["score"] for r in rule_ensemble.score(odd, labels.limit(0)).collect()} == {0.5}


def test_severity(spark, odd):
    rng = random.Random(4)
    common = [f"word{c}" for c in "abcdefghij"]
    clean = [(i, " ".join(rng.choice(common) for _ in range(60)), 0) for i in range(200)]
    toxic = [(1000 + i, " ".join(rng.choice(common) for _ in range(60)) + " vilexa" * (1 + i % 9), 1) for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t, _ in clean + toxic], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in clean + toxic], "doc_id bigint, toxic int")
    model = severity.fit(df, labels)
    assert (np.diff(model.cuts) > 0).all()
    got = {r["doc_id"]: r for r in severity.score(df, model).collect()}
    assert all(got[i]["toxic"] == bool(y) for i, _, y in clean + toxic)
    assert got[1008]["expected_severity"] > got[1000]["expected_severity"] > got[0]["expected_severity"]
    edge = severity.score(odd, model)
    assert edge.count() == odd.count() and not edge.where("expected_severity is null").count()
    assert not severity.score(odd, severity.fit(odd, labels.limit(0))).where("toxic").count()


def test_ordinal_gradient():
    """Few steps lower the loss, and the weights order the grades."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, severity.GRADES, 200)
    vectors = [([0, 1], [float(k) + rng.normal() * 0.1, rng.normal()]) for k in y]
    w, cuts = severity.fit_ordinal(vectors, y, 2)
    z = np.array([w[0] * v[0] + w[1] * v[1] for _, v in vectors])
    assert w[0] > 1 and abs(w[1]) < w[0] / 4
    assert np.corrcoef(severity.expected(z, cuts), y)[0, 1] > 0.95


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a><li><a>B</a></ul></nav>
<div class="ad">Buy this now please</div>
<article><h1>Head &amp; line</h1><p><b>First
 para<br>goes on<p>Short.</p><aside>Side note</aside><p>x &lt; y &copy; <a href="/l">a link</a> in text</p>
<form><label>Name</label><input></form><script>var t="</p>";</script><!-- <p>no</p> -->
<section class="comments"><p>A reader says</p></section></article>
<footer>&copy; site</footer></body></html>"""


def test_page_text(spark):
    data = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "plain words only " * 12), (None, "u", "<p>cut off <b"),
            (6, "u", PAGE[: PAGE.index("<footer>") + 12]), (1, "u", PAGE), (7, "u", "<article><p>a" + "<div>" * 5_000 + "deep")]
    df = spark.createDataFrame(data, "page_id int, url string, html string").withColumn("text", F.lit("own"))
    got = {}
    for r in html_blocks.extract(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    main = "Head & line\nFirst para goes on\nShort.\nx < y © a link in text"
    assert got[1] == [main, main]
    assert got[2] == [""] and got[3] == [""]
    assert got[4] == [("plain words only " * 12).strip()]
    assert got[6] == [main]
    assert got[7] == ["a\ndeep"]


def test_tree_keeps_all_of_an_article_and_no_furniture():
    tree, rng = html_blocks.train(), random.Random(1)
    for _ in range(3_000):
        x = [rng.choice([1, 2, 5, 20, 300]), rng.choice([0, 0.1, 0.6, 1.0])] * 3
        assert html_blocks.decide(tree, [*x, 0.0, 1.0]) >= 0.5
        assert html_blocks.decide(tree, [*x, 1.0, rng.choice([0.0, 1.0])]) < 0.5


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    vocabulary = pieces.load()
    outs = [
        line_rules.judge(empty), line_rules.clean(empty), secrets.findings(empty)[0], secrets.redact(empty), pii.find(empty)[0],
        pii.sanitise(empty), simhash.near_duplicates(empty), simhash.keep_one(empty), decontaminate.search(empty, bench),
        decontaminate.clean(empty, bench), longest_previous.remove_repeats(empty), pieces.encode(empty, vocabulary),
        rule_ensemble.score(empty, labels), severity.score(empty, severity.fit(empty, labels)),
        html_blocks.extract(spark.createDataFrame([], "page_id int, url string, html string")),
    ]
    assert [df.count() for df in outs] == [0] * len(outs)
