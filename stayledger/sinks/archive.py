"""Moving files that are taken in out of the landing folder.

The manifest stays the source of truth: a file is moved once its entry says that it is taken in, refused and passed-over
files stay.  Runs list the landing folder, so they get shorter with every file that is gone from it.  Moves are renames
on the file system of the landing folder; a name that the archive has already stays where it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.sinks.manifest import loaded_files
from stayledger.sinks.tables import Ledger


def taken_files(ledger: Ledger, files: DataFrame) -> DataFrame:
    """Listed files of the snapshots, and of the days of snapshots, that are taken in."""
    taken = loaded_files(ledger).select("PROPERTY", "NAME").distinct()
    return files.join(taken, ["PROPERTY", "NAME"], "left_semi")


def archive_taken(ledger: Ledger, files: DataFrame, root: str, archive: str) -> tuple[int, int]:
    """Move the taken files among the listed ones below ``archive``, under their path below ``root``.

    Returns how many were moved and how many could not be.  Only names pass through the driver, one at a time."""
    jvm = ledger.spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(archive).getFileSystem(ledger.spark._jsc.hadoopConfiguration())
    base = system.makeQualified(path(root)).toUri().getPath().rstrip("/")
    moved = kept = 0
    for row in taken_files(ledger, files).select("PATH").toLocalIterator():
        source = path(row.PATH)
        below = source.toUri().getPath().removeprefix(base).lstrip("/")
        target = path(path(archive), below)
        system.mkdirs(target.getParent())
        if not system.exists(target) and system.rename(source, target):
            moved += 1
        else:
            kept += 1
    return moved, kept
