"""Landing folders as a file stream: every new file once, then staging, then the marts.

The stream carries file names, not contents: each micro-batch hands its listing
to the batch plans.  They replace by key, so a batch that is run again after a
failure gives the same tables, and the batch ledger tells which batches are done.
The marts are refreshed for the days of the batch's files alone.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stayledger.dimensions import SITES, Site, site_registry
from stayledger.plans import ledger as marts
from stayledger.plans.staging import DAILY_LAYOUTS, Layout, retry_failed, stage_listing
from stayledger.session import pin, pin_keys
from stayledger.sinks.tables import Ledger
from stayledger.sources.files import file_columns, with_property, with_report_day
from stayledger.streaming import batches

# A file that arrives late carries an old time and must not be taken for forgotten.
MAX_FILE_AGE = "36500d"

_BINARY = "path string, modificationTime timestamp_ltz, length bigint, content binary"


def new_file_stream(ledger: Ledger, root: str, max_files: int | None = None) -> DataFrame:
    """Listing of the files below the root as a stream.

    Files are told apart by their whole path, since two sites may use one name."""
    reader = (
        ledger.spark.readStream.format("binaryFile")
        .schema(_BINARY)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", MAX_FILE_AGE)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return file_columns(reader.load(root))


def stage_stream(
    ledger: Ledger,
    root: str,
    checkpoint: str,
    sites: tuple[Site, ...] = SITES,
    layouts: dict[str, Layout] = DAILY_LAYOUTS,
    max_files: int | None = None,
    then: Callable[[Ledger, DataFrame], None] | None = None,
    as_of: date | None = None,
) -> StreamingQuery:
    """Take in what has landed and stop; ``then`` runs after each batch is staged, with the days (PROPERTY, REPORT_DATE)
    of the batch's files.  A batch is done, and in the batch ledger under ``as_of``, when ``then`` is through.

    Batches may bring a day's files in any order, so a file older than the loaded
    one of its day does not replace it."""

    def take_in(batch: DataFrame, number: int) -> None:
        # Everything of one batch runs in the batch's own session.
        here = Ledger(batch.sparkSession, ledger.database)
        stream = batches.stream_id(here, checkpoint)
        if batches.is_done(here, stream, number):
            return
        registry = site_registry(here.spark, sites, *layouts)
        listed = pin(with_report_day(with_property(batch, registry)))
        stage_listing(here, listed, layouts, strict_latest=True)
        # Files staged by an earlier try of the batch are in the manifest, so their days are among these.
        days = pin_keys(batches.batch_days(here, listed))
        if then is not None:
            then(here, days)
        batches.record(here, stream, number, days, as_of or date.today())

    # The stream has a refused file behind it, even when it was mended since.
    ledger.refresh()
    mended = retry_failed(ledger, root, sites, layouts)
    if mended is not None and then is not None:
        then(ledger, pin_keys(batches.batch_days(ledger, mended)))
    return (
        new_file_stream(ledger, root, max_files)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_stream(ledger: Ledger, root: str, checkpoint: str, as_of: date, **options) -> StreamingQuery:
    """The same, bringing all marts up to date for the days of each batch."""
    return stage_stream(
        ledger, root, checkpoint, then=lambda here, days: marts.refresh_days(here, days, as_of), as_of=as_of, **options
    )
