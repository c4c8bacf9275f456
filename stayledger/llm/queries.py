"""The registered queries: each applies one operator, with production parameters, to its whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayledger.llm import (
    collocations,
    decontaminate,
    divergence,
    html_blocks,
    language_id,
    line_rules,
    longest_previous,
    pieces,
    pii,
    rule_ensemble,
    secrets,
    severity,
    simhash,
    twins,
)
from stayledger.llm.common import listed, read
from stayledger.llm.registry import query


def _n(kind: str):
    """Number of spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@query("op1_pii")
def op1_pii(spark, sf_dir):
    found = pii.find(read(spark, sf_dir, "documents"))[0]
    return found.select(
        "doc_id",
        *map(_n, pii.KINDS),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@query("op3_decontamination", twins.OP3)
def op3_decontamination(spark, sf_dir):
    found = decontaminate.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op4_longest_previous", twins.OP4)
def op4_longest_previous(spark, sf_dir):
    found = longest_previous.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_severity")
def op5_severity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return severity.score(docs, severity.fit(docs, read(spark, sf_dir, "labels")))


@query("op6_html_blocks")
def op6_html_blocks(spark, sf_dir):
    found = html_blocks.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op7_secrets", twins.OP7)
def op7_secrets(spark, sf_dir):
    found = secrets.findings(read(spark, sf_dir, "documents"))[0]
    text = listed(F.col("spans"))
    return found.select("doc_id", *map(_n, secrets.RULES), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@query("op8_rule_ensemble")
def op8_rule_ensemble(spark, sf_dir):
    return rule_ensemble.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op9_line_rules", twins.OP9)
def op9_line_rules(spark, sf_dir):
    return line_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_pieces")
def op10_pieces(spark, sf_dir):
    vocabulary = pieces.load()
    encoded = pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    both = pieces.decode(encoded, vocabulary)
    return both.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query("op11_collocations", twins.OP11)
def op11_collocations(spark, sf_dir):
    return collocations.mine(read(spark, sf_dir, "documents"))


@query("op12_divergence", twins.OP12)
def op12_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


@query("op13_language_id")
def op13_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs)).select("doc_id", "held_out", "lang_pred", "score")
