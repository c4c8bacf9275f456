"""Columns of the user that are named like a stage's own come back with their values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from edge import docs  # noqa: F401
from stayledger.llm import decontaminate, line_rules, pii, secrets, simhash

NAMES = (
    "own own_hash first_id first_hash root component_id body_hash j_id j_host j_hash j_places j_body cut_places in_host line_hash"
    " d_blob f_blob f_spans due_blob rep kinds s_id s_hash s_body s_spans l_id l_hash gone term terms h_id h_hash hit_id hit_hash"
    " h_spans h_items s i n_words spans items fp node digest k key part crowded"
).split()
STAGES = {
    "line_rules": lambda df, bench: line_rules.clean(df, min_docs=1, share=0.3),
    "simhash": lambda df, bench: simhash.keep_one(df),
    "decontaminate": decontaminate.clean,
    "secrets": lambda df, bench: secrets.redact(df),
    "pii": lambda df, bench: pii.sanitise(df),
}


@pytest.mark.parametrize("stage", STAGES)
def test_clashing_columns_keep_their_values(spark, docs, stage):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id int, text string")
    given = docs.select("*", *(F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in NAMES))
    plain = STAGES[stage](docs, bench)
    got = STAGES[stage](given, bench)
    assert got.columns == given.columns
    rows = got.collect()
    assert all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in NAMES)
    held = sorted(str(tuple(r[n] for n in docs.columns)) for r in rows)
    assert held == sorted(str(tuple(r)) for r in plain.collect())
