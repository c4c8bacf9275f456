"""Which micro-batches of which stream are in the marts.

A stream that breaks off runs its last batch again.  The batch ledger has a line per batch, written when its marts are in
place, so a batch that comes again after success is recognised; one that broke off in between has no line, and its days,
which follow from its files, are refreshed again.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.operators.changes import DAY_KEY
from stayledger.schemas import STREAM_BATCHES, conform
from stayledger.sinks.manifest import loaded_files
from stayledger.sinks.tables import Ledger, listed_days

BATCHES = "stream_batches"


def stream_id(ledger: Ledger, checkpoint: str) -> str:
    """The id that Spark gave the stream at its first start and keeps in its checkpoint."""
    return json.loads(ledger.spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def is_done(ledger: Ledger, stream: str, batch: int) -> bool:
    line = (F.col("STREAM_ID") == stream) & (F.col("BATCH_ID") == batch)
    return not ledger.table(BATCHES).filter(line).isEmpty()


def batch_days(ledger: Ledger, files: DataFrame) -> DataFrame:
    """(PROPERTY, REPORT_DATE) of those of the files that staging has taken in."""
    taken = files.join(loaded_files(ledger).select("PROPERTY", "NAME").distinct(), ["PROPERTY", "NAME"], "left_semi")
    return taken.select(*DAY_KEY).dropna().distinct()


def record(ledger: Ledger, stream: str, batch: int, days: DataFrame, as_of: date) -> None:
    """Write the batch's line; the same line written again replaces itself."""
    key = ledger.spark.createDataFrame([(stream, batch)], "STREAM_ID string, BATCH_ID bigint")
    line = key.withColumns({
        "DAYS": F.lit(sorted(listed_days(days.select("REPORT_DATE")))).cast("array<date>"), "AS_OF": F.lit(as_of),
    })
    ledger.replace_keys(BATCHES, key, conform(line, STREAM_BATCHES), present=line)
