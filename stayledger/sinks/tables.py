"""Catalog tables partitioned by day, and the mutations the jobs need.

A plain parquet table has no DELETE.  Replacing keys means writing the touched
days anew, kept rows and new ones together, and dropping a day that became
empty, which is one whose files the write left as they were.  Other days are
neither read nor written.  The day alone is the partition:
partitions stay as many as there are days, however many properties there are,
and rows are sorted by property inside, so a property's rows sit together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger import schemas
from stayledger.session import FREES_SHUFFLES, key_join, pin_keys, settings


@dataclass(frozen=True)
class TableDef:
    """Columns, the day column it is partitioned by, and the key its rows are replaced by."""

    columns: dict[str, str]
    day: str
    key: tuple[str, ...]


def _by_property(columns: dict[str, str], day: str) -> TableDef:
    return TableDef(columns, day, ("PROPERTY", day))


TABLES: dict[str, TableDef] = {
    "stg_smile": _by_property(schemas.STG_SMILE, "REPORT_DATE"),
    "stg_opera": _by_property(schemas.STG_OPERA, "REPORT_DATE"),
    "booking_pace_detail": _by_property(schemas.DETAIL, "REPORT_DATE"),
    "booking_pace_history": _by_property(schemas.HISTORY, "STAYING"),
    "booking_pace_report": _by_property(schemas.REPORT, "REPORT_DATE"),
    "booking_pace_actual": _by_property(schemas.ACTUAL, "STAYING_DATE"),
    "booking_pace_sample_data": _by_property(schemas.SAMPLE, "REPORT_DATE"),
    "exchange_rate": TableDef(
        schemas.EXCHANGE_RATE, "REPORT_DATE", ("REPORT_DATE", "FROM_CURRENCY_CODE", "TO_CURRENCY_CODE")
    ),
    "load_manifest": TableDef(schemas.MANIFEST, "REPORT_DATE", ("PROPERTY", "NAME")),
    "load_rejects": TableDef(schemas.LOAD_REJECTS, "REPORT_DATE", ("PROPERTY", "REPORT_DATE")),
    "audit": TableDef(schemas.AUDIT, "AUDIT_DATE", ("MART", "AUDIT_DATE")),
    "day_versions": TableDef(schemas.DAY_VERSIONS, "DAY", ("TABLE_NAME", "DAY")),
    "stream_batches": TableDef(schemas.STREAM_BATCHES, "AS_OF", ("STREAM_ID", "BATCH_ID")),
}
# Kept beside any other tables.
_BESIDE = ("day_versions", "stream_batches")

DROP_BATCH = 200
# A day in more files than this is gathered into few by the next replacement.
FILES_A_DAY = 64
# Files that a task keeps open for rows that come in day by day or nearly so; with more days it sorts its rows.
OPEN_FILES = 32


def _write_mode(spark: SparkSession, overwrite: str, open_files: int):
    wanted = {"spark.sql.sources.partitionOverwriteMode": overwrite, "spark.sql.maxConcurrentOutputFileWriters": str(open_files)}
    return settings(spark, wanted | FREES_SHUFFLES)


@dataclass(frozen=True)
class Ledger:
    """The tables of one database."""

    spark: SparkSession
    database: str = "default"

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def refresh(self) -> None:
        """Forget cached file listings: another session, such as a stream's, may have written since."""
        for table in TABLES:
            if self.spark.catalog.tableExists(self.name(table)):
                self.spark.catalog.refreshTable(self.name(table))

    def create(self, location: str | None = None, tables: dict[str, TableDef] = TABLES) -> None:
        """Create what does not exist yet, below ``location`` when given, else where the catalog puts it."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, spec in {**tables, **{t: TABLES[t] for t in _BESIDE}}.items():
            where = f"LOCATION '{location}/{table}'" if location else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({schemas.ddl(spec.columns)}) "
                f"USING parquet PARTITIONED BY ({spec.day}) {where}"
            )

    def append(self, table: str, rows: DataFrame, placed: bool = False) -> None:
        """``placed``: the rows come from files that hold one day each, as those of these tables, and in their order;
        they are written as they come, not dealt out and sorted anew, in no more files than they were read from."""
        self._insert(table, rows, placed=placed)

    def truncate_load(self, table: str, rows: DataFrame, placed: bool = False) -> None:
        """Replace the whole table."""
        self._insert(table, rows, overwrite="static", placed=placed)

    def files(self, table: str, days: list[date] | None = None) -> dict[date | None, frozenset[str]]:
        """Names of the files of each day (of the given ones), as Spark lists them; no file is opened."""
        day = TABLES[table].day
        stored = self.table(table) if days is None else self.table(table).filter(F.col(day).isin(days))
        found: dict[date | None, set[str]] = {}
        for uri in stored.inputFiles():
            value, name = re.search(rf"/{day}=([^/]*)/([^/]*)$", uri).groups()
            at = None if value == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(value)
            if days is None or at in days:
                found.setdefault(at, set()).add(name)
        return {at: frozenset(names) for at, names in found.items()}

    def replace_keys(
        self,
        table: str,
        keys: DataFrame,
        rows: DataFrame,
        on: tuple[str, ...] | None = None,
        present: DataFrame | None = None,
        placed: bool = False,
    ) -> None:
        """Replace the rows of ``keys`` by ``rows``; a key without new rows ends up empty.

        ``rows`` must lie within the keys, and are computed once.  Only where the key has no day do their days
        have to be known beforehand: ``present`` has them, where the caller knows them without computing the rows.
        New days are moved in before emptied ones go, so an interrupted run leaves old rows
        rather than none, and running it again completes it."""
        spec = TABLES[table]
        on = on or spec.key
        stored = self.table(table)
        keys = pin_keys(keys.select(*on).dropna().distinct())
        touched = keys.select(spec.day) if spec.day in on else None
        if touched is None:
            new_days = (rows if present is None else present).select(spec.day).distinct()
            touched = stored.join(keys, list(on), "left_semi").select(spec.day).union(new_days)
        days = listed_days(touched)
        if not days:
            return
        kept = key_join(stored.filter(F.col(spec.day).isin(days)), keys, on, "left_anti")
        merged = schemas.conform(kept, spec.columns).unionByName(schemas.conform(rows, spec.columns))
        before = self.files(table, days)
        few = all(len(files) <= FILES_A_DAY for files in before.values())
        self._insert(table, merged, overwrite="dynamic", placed=placed and few)
        after = self.files(table, days)
        self._drop_days(table, sorted(d for d, files in before.items() if after.get(d) == files))

    def delete_keys(self, table: str, keys: DataFrame, on: tuple[str, ...] | None = None) -> None:
        """Remove the rows of the keys."""
        self.replace_keys(table, keys, self.table(table).limit(0), on)

    def _drop_days(self, table: str, days: list[date]) -> None:
        for some in batched(days, DROP_BATCH):
            specs = ", ".join(f"PARTITION (`{TABLES[table].day}` = '{day.isoformat()}')" for day in some)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {specs}")

    def _insert(self, table: str, rows: DataFrame, overwrite: str | None = None, placed: bool = False) -> None:
        spec = TABLES[table]
        ordered = [c for c in spec.columns if c != spec.day] + [spec.day]
        inner = [c for c in spec.key if c != spec.day]
        rows = schemas.conform(rows, spec.columns).select(*ordered)
        if not placed:
            # The rebalance lets AQE split a heavy day over tasks and merge light ones.
            rows = rows.hint("rebalance", spec.day).sortWithinPartitions(spec.day, *inner)
        # The mode is read from the session of the frame that is written.
        with _write_mode(rows.sparkSession, overwrite or "static", OPEN_FILES if placed else 0):
            rows.write.insertInto(self.name(table), overwrite=overwrite is not None)


def listed_days(df: DataFrame) -> list[date]:
    """Distinct known days of a one-column frame: at most one value per calendar day."""
    return [row[0] for row in df.dropna().distinct().collect()]
