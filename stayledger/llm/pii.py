"""Personal data: spans by rule, and terms that disclose a protected entity by co-occurrence.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.  Each distinct value is a protected entity.
A term (a word of letters, four or more, not part of an address) that stands within ``NEAR`` code points of an entity
co-occurs with it.  With documents as the unit, over the whole corpus,

    disclosure(term, entity) = PMI(term; entity) / I(entity)
                             = log(n_te * N / (n_t * n_e)) / log(N / n_e)

is the share of the entity's information that the term gives away: 1 when the term stands nowhere else.  A pair counts
only if ``SUPPORT`` distinct texts have it, so copies of a text are no evidence.  Terms above ``GENERALISE`` are
replaced by a class, above ``REMOVE`` they are removed, wherever they stand.

Defined results: null and empty texts have no spans; repeated rows get the same spans each; an entity in every document
carries no information and discloses nothing; an empty table gives an empty result; other columns are not read.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import BROADCAST_ROWS, fresh, gated, located, masked, sized, stored, tagged

NEAR = 60
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95
# Kinds in the order in which spans of one start are listed.
KINDS = ["email", "ip", "card", "phone"]
# A match begins where a run of its first characters begins or the last match ended; runs are never given back.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BEFORE = r"(?<![\p{L}\p{N}@._%+-])"
_AFTER = r"(?![\p{L}\p{N}@_]|[.@-][\p{L}\p{N}])"
TERM = _BEFORE + r"\p{L}{4,}" + _AFTER


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _byte_parts(hit: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    return F.forall(
        F.split(hit, r"\.", -1), lambda p: F.rlike(p, F.lit(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"))
    )


def _luhn(digits: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step)
    return F.length(digits).between(12, 19) & (total % 10 == 0)


def _found(kind: str, text: Column) -> Column:
    if kind == "email":
        return gated(F.contains(text, F.lit("@")), located(text, _EMAIL))
    if kind == "ip":
        gate = F.rlike(text, F.lit(r"[0-9]\.[0-9]"))
        return F.filter(gated(gate, located(text, _IP)), lambda s: _byte_parts(s["hit"]))
    if kind == "card":
        gate = F.rlike(text, F.lit(_CARD))
        return F.filter(gated(gate, located(text, _CARD)), lambda s: F.when(F.length(_digits(s["hit"])) <= 19, _luhn(_digits(s["hit"]))))
    gate = F.contains(text, F.lit("+"))
    return F.filter(
        gated(gate, located(text, _PHONE)), lambda s: F.length(_digits(s["hit"])).between(9, 15)
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, body hash, sorted tagged spans, and the entities (kind, value, text around) of each row."""
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    each = body.select("doc_id", "body", F.xxhash64("body").alias("body_hash"), *(_found(k, F.col("body")).alias(k) for k in KINDS))
    near = [
        F.transform(
            k,
            lambda s: F.struct(
                F.concat(F.lit(k + ":"), F.lower(s["hit"])).alias("entity"),
                F.concat_ws(
                    " ",
                    # A word cut by the edge of the stretch is not whole: from the first space on, to the last.
                    F.regexp_replace(
                        F.substring("body", F.greatest(s["start"] - NEAR + 1, F.lit(1)), F.least(s["start"], F.lit(NEAR))),
                        F.when(s["start"] > NEAR, F.lit(r"^\S*")).otherwise(F.lit(r"^$")),
                        F.lit(""),
                    ),
                    F.regexp_replace(
                        F.substring("body", s["end"] + 1, F.lit(NEAR)),
                        F.when(s["end"] + NEAR < F.length("body"), F.lit(r"\S*$")).otherwise(F.lit(r"^$")),
                        F.lit(""),
                    ),
                ).alias("around"),
            ),
        )
        for k in KINDS
    ]
    return each.select(
        "doc_id",
        "body_hash",
        F.sort_array(F.concat(*(tagged(F.col(k), k, i + 1) for i, k in enumerate(KINDS)))).alias("base"),
        F.concat(*near).alias("entities"),
    )


def doc_terms(docs: DataFrame) -> DataFrame:
    """One row per document row and distinct term, in lower case."""
    low = F.lower(F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("body_hash"),
        F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))).alias("term"),
    )


def disclosing_terms(
    docs: DataFrame,
    marks: DataFrame,
    support: int = SUPPORT,
    threshold: float = GENERALISE,
) -> DataFrame:
    """term and its largest disclosure, for the terms above the threshold; ``marks`` as of ``base_spans``."""
    held = marks.select("doc_id", "body_hash", F.explode("entities").alias("e"))
    n_e = held.select("doc_id", "e.entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = (
        held.select(
            "doc_id", "body_hash", "e.entity",
            F.explode(F.array_distinct(F.regexp_extract_all(F.lower("e.around"), F.lit(TERM), F.lit(0)))).alias("term"),
        )
        .distinct()
        .groupBy("term", "entity")
        .agg(F.count_distinct("doc_id").alias("n_te"), F.count_distinct("body_hash").alias("texts"))
        .where(F.col("texts") >= support)
    )
    pairs = stored(pairs, "pairs")
    # Counted over all documents, combined before the shuffle.  Joined after, and not by a semi join, which
    # would be moved below the sums and bring every occurrence of a frequent candidate.
    n_t = doc_terms(docs).groupBy("term").agg(F.count("*").alias("n_t"))
    total = docs.count()
    told = F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n_t") * F.col("n_e")))
    worth = F.log2(F.lit(float(total)) / F.col("n_e"))
    return (
        pairs.join(n_t, "term")
        .join(n_e, "entity")
        .where(worth > 0)
        .groupBy("term")
        .agg(F.max(told / worth).alias("disclosure"))
        .where(F.col("disclosure") >= threshold)
    )


def find(docs: DataFrame, **limits: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, body_hash, base, spans of every row; the disclosing terms).

    Spans are the base spans and those of kind ``term``, sorted."""
    marks = stored(base_spans(docs), "pii")
    terms = stored(disclosing_terms(docs, marks, **limits), "terms")
    hits = doc_terms(docs).join(sized(terms.select(F.col("term").alias("t"))), F.col("term") == F.col("t"), "left_semi")
    hits = stored(
        hits.groupBy(F.col("doc_id").alias("h_id"), F.col("body_hash").alias("h_hash")).agg(F.collect_set("term").alias("terms")),
        "hits",
    )
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body")).withColumn("body_hash", F.xxhash64("body"))
    held = body.join(
        sized(hits, BROADCAST_ROWS // 10), F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("body_hash") == F.col("h_hash"))
    )
    # Terms are letters only, so the row's list is a pattern as it stands.
    wanted = F.concat(F.lit("(?iu)" + _BEFORE + "(?:"), F.array_join("terms", "|"), F.lit(")" + _AFTER))
    found = held.select(
        "h_id",
        "h_hash",
        tagged(
            F.filter(located(F.col("body"), wanted), lambda s: F.array_contains("terms", F.lower(s["hit"]))), "term", 5
        ).alias("more"),
    ).dropDuplicates(["h_id", "h_hash"])
    joined = marks.join(
        found, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("body_hash") == F.col("h_hash")), "left"
    )
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "more")))
    return joined.select("doc_id", "body_hash", "base", spans.alias("spans")), terms


def sanitise(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """Documents with entities replaced by their kind, and disclosing terms by ``[TERM]`` or nothing; columns as given."""
    spans, terms = find(docs, support=support, threshold=generalise)
    s_id, s_hash, s_spans, own, l_id, l_hash, l_terms = (fresh(x) for x in ("id", "hash", "spans", "own", "l_id", "l_hash", "terms"))
    marked = (
        spans.where(F.size("spans") > 0)
        .select(F.col("doc_id").alias(s_id), F.col("body_hash").alias(s_hash), F.col("spans").alias(s_spans))
        .dropDuplicates([s_id, s_hash])
    )
    strong = terms.where(F.col("disclosure") >= remove).select("term")
    with_text = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit("")))).join(
        marked, F.col("doc_id").eqNullSafe(F.col(s_id)) & (F.col(own) == F.col(s_hash)), "left"
    )
    # The strong terms that stand in a row, as a list beside it.
    listed = (
        doc_terms(docs)
        .join(sized(stored(strong, "strong")), "term", "left_semi")
        .groupBy(F.col("doc_id").alias(l_id), F.col("body_hash").alias(l_hash))
        .agg(F.collect_set("term").alias(l_terms))
    )
    with_text = with_text.join(
        listed, F.col("doc_id").eqNullSafe(F.col(l_id)) & (F.col(own) == F.col(l_hash)), "left"
    )
    gone = F.coalesce(l_terms, F.array().cast("array<string>"))
    masks = F.transform(
        s_spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.when(
                (s["kind"] == "term")
                & F.array_contains(gone, F.lower(F.substr("text", s["start"] + 1, s["end"] - s["start"]))),
                "",
            )
            .otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .alias("mask"),
        ),
    )
    text = F.when(F.col(s_spans).isNotNull(), masked(F.col("text"), masks)).otherwise(F.col("text"))
    return with_text.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)
