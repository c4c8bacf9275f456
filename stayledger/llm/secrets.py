"""Secret scans with an incremental ledger of blobs.

Each version of a document is content-addressed (SHA-256 of its text).  The ledger holds, for every blob and rule version
scanned so far, the spans found.  A scan takes the distinct blobs of the given documents, drops the (blob, rule version)
pairs the ledger has, reads one copy of each remaining blob, and joins all findings back to every path.

Defined results: null and empty texts are one blob without findings; repeated rows come back as often as given; an
empty table gives an empty result; other columns are not read.  Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import fresh, gated, located, masked, stored, tagged

_KEY = r"(?i:password|passwd|secret|token|api_?key)"
_ASSIGN = _KEY + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ACCESS = r"AKIA[A-Z0-9]{14,}"
_HEX = r"[0-9a-f]{16,}"
# Kind to (order, version): raise a version when its rule changes, and only that rule is scanned anew.
RULES = {"assign": (1, 1), "access": (2, 1), "hex": (3, 1)}
LEDGER = "blob string, kind string, version int, spans array<struct<start:int,rank:int,end:int,kind:string>>"
MASK = "[SECRET]"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find(kind: str, text: Column) -> Column:
    """Tagged spans of one rule."""
    if kind == "assign":
        low = F.lower(text)
        gate = F.lit(False)
        for key in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            gate = gate | F.contains(low, F.lit(key))
        spans = F.filter(
            gated(gate, located(text, _ASSIGN.replace("([", "(?:["))),
            lambda s: F.length(F.regexp_extract(s["hit"], _ASSIGN, 1)) >= 12,
        )
    elif kind == "access":
        spans = gated(F.contains(text, F.lit("AKIA")), located(text, _ACCESS))
    elif kind == "hex":
        spans = gated(F.rlike(text, F.lit(_HEX)), located(text, _HEX))
    else:
        raise ValueError(f"no rule {kind}")
    return tagged(spans, kind, RULES[kind][0])


def versions(docs: DataFrame) -> DataFrame:
    """doc_id and blob of each row."""
    return docs.select("doc_id", blob_id(F.col("text")).alias("blob"))


def unseen(paths: DataFrame, ledger: DataFrame, kind: str) -> DataFrame:
    """Blobs without an entry for the rule's version."""
    blobs = paths.select("blob").distinct()
    done = ledger.where((F.col("kind") == kind) & (F.col("version") == RULES[kind][1])).select("blob").distinct()
    return blobs.join(done, "blob", "left_anti")


def scan(docs: DataFrame, ledger: DataFrame | None = None, paths: DataFrame | None = None) -> DataFrame:
    """New ledger entries: one per unseen (blob, rule version), with the spans found (maybe none)."""
    paths = versions(docs) if paths is None else paths
    # One copy of each blob: the row with the smallest doc_id.
    wanted = paths.groupBy("blob").agg(F.min("doc_id").alias("rep"))
    if ledger is None:
        wanted = wanted.withColumn("kinds", F.array(*(F.lit(k) for k in RULES)))
    else:
        due = reduce(
            DataFrame.unionByName,
            (unseen(paths, ledger, kind).select("blob", F.lit(kind).alias("kind")) for kind in RULES),
        )
        wanted = wanted.join(due.groupBy("blob").agg(F.collect_set("kind").alias("kinds")), "blob")
    copies = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    copies = copies.join(
        wanted.select("rep", "kinds", F.col("blob").alias("due_blob")),
        F.col("doc_id").eqNullSafe(F.col("rep")) & (F.sha2("body", 256) == F.col("due_blob")),
    )
    found = copies.select(
        F.col("due_blob").alias("blob"),
        "kinds",
        F.array(
            *(
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(version).alias("version"),
                    find(kind, F.col("body")).alias("spans"),
                )
                for kind, (_, version) in RULES.items()
            )
        ).alias("entries"),
    )
    return (
        found.select("blob", F.explode(F.filter("entries", lambda e: F.array_contains("kinds", e["kind"]))).alias("e"))
        .select("blob", "e.kind", "e.version", "e.spans")
        .dropDuplicates(["blob", "kind"])
    )


def findings(docs: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, sorted spans of every row; the ledger with the new entries)."""
    paths = stored(versions(docs), "versions")
    entries = stored(scan(docs, ledger, paths), "ledger")
    book = entries if ledger is None else ledger.select(*entries.columns).unionByName(entries)
    hits = (
        book.where(F.size("spans") > 0)
        .where(" OR ".join(f"(kind = '{k}' AND version = {v})" for k, (_, v) in RULES.items()))
        .select("blob", "spans")
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    joined = paths.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))
    return joined, book


def redact(docs: DataFrame, ledger: DataFrame | None = None, mask: str = MASK) -> DataFrame:
    """Documents with every span found replaced by the mask; columns as given."""
    f_blob, f_spans, own = (fresh(x) for x in ("blob", "spans", "own"))
    hits = (
        findings(docs, ledger)[0]
        .where(F.size("spans") > 0)
        .select(F.col("blob").alias(f_blob), F.col("spans").alias(f_spans))
        .dropDuplicates([f_blob])
    )
    joined = docs.withColumn(own, blob_id(F.col("text"))).join(hits, F.col(own) == F.col(f_blob), "left")
    marked = F.transform(
        f_spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mask).alias("mask"))
    )
    text = F.when(F.col(f_spans).isNotNull(), masked(F.col("text"), marked)).otherwise(F.col("text"))
    return joined.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)
