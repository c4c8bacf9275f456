"""What a run needs for a while only is gone from the disk when it is through."""

from __future__ import annotations

import glob
import gzip
import os
import time
from datetime import date
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from conftest import rows
from stayledger.plans import staging
from stayledger.session import discard, kept, shared_dir
from test_files import DAILY, HISTORY, NIGHT, SITES, opera_text, put, statuses
from workload.landing import write_files


def _copies(spark):
    folder = urlsplit(shared_dir(spark)).path
    return {name for name in os.listdir(folder) if name.startswith(("typed-", "rejects-"))}


def _shuffles(spark):
    top = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {path for at in top for path in glob.glob(f"{at}/*/shuffle_*.data")}


def test_staging_leaves_no_typed_copy(spark, ledger, tmp_path):
    put(tmp_path / "in", "CPV", "pace_01082025.txt", opera_text(NIGHT))
    before = _copies(spark)
    staging.stage_incremental(ledger, str(tmp_path / "in"), SITES, layouts=DAILY)
    assert ledger.table("stg_opera").count() == 1
    assert _copies(spark) == before


def test_histories_leave_no_typed_copy(spark, ledger, tmp_path):
    put(tmp_path / "in", "CPV", "CPV_history.txt", opera_text(("01/Aug/25", "", "", "", 1), ("31/Feb/25", "", "", "", 2)), "utf-16")
    before = _copies(spark)
    staging.history_incremental(ledger, str(tmp_path / "in"), SITES, layouts=HISTORY)
    assert rows(ledger.table("booking_pace_history"), "STAYING") == [(date(2025, 8, 1),)]
    assert ledger.table("load_rejects").count() == 1
    assert _copies(spark) == before


def test_only_the_given_copy_is_discarded(spark):
    one, two = kept(spark.range(3), "typed"), kept(spark.range(4), "typed")
    discard(one)
    assert two.count() == 4
    discard(two)


def test_a_write_frees_its_shuffle_files(spark, ledger):
    spark._jvm.System.gc()
    time.sleep(1)
    before = _shuffles(spark)
    copy = kept(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "typed")
    until = time.time() + 20
    while _shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert copy.count() == 7
    discard(copy)


def test_landed_parts_are_compressed_and_read(spark, ledger, tmp_path):
    root = str(tmp_path / "in")
    night = dict(zip(("ARR", "CREATED_DATE", "CONSIDERED_DATE", "DEP", "NO_ROOMS"), NIGHT))
    cells = F.struct(*(F.lit(night.get(c)).cast("string").alias(c) for c in staging.OPERA_FILE))
    write_files(root, spark.range(1).select(cells.alias("CELLS")), F.lit("CPV"), F.lit("pace_01082025.txt"), "\t")
    (part,) = glob.glob(f"{root}/FOLDER=CPV/NAME=*/part-*")
    with gzip.open(part, "rt") as file:
        assert len(file.read().splitlines()) == 2
    staging.stage_incremental(ledger, root, SITES, layouts=DAILY)
    assert statuses(ledger) == [("pace_01082025.txt", "LOADED", None)]
    assert ledger.table("stg_opera").count() == 1
