"""Session factory, eager materialisation, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "stayledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs assume; cluster sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; on a local master one is made when none is set."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="stayledger-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute now and cut the lineage, on shared storage, so that later changes
    to the tables it was read from (or a lost executor) do not change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """These session settings meanwhile, the former ones afterwards."""
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# A write gives its shuffle files back when it is through, not when the driver next happens to collect its garbage.
FREES_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def kept(df: DataFrame, label: str) -> DataFrame:
    """Compute once, written to shared storage and read back: what ``pin`` is to lists, for rows by the million.
    Unlike a checkpoint it is columnar and compressed, and a reader takes the columns it needs."""
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, FREES_SHUFFLES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*copies: DataFrame) -> None:
    """Delete what ``kept`` wrote for these frames, once nothing is to be read from them."""
    for copy in copies:
        spark = copy.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        below = path(shared_dir(spark)).toUri().getPath()
        for folder in {uri.rsplit("/", 1)[0] for uri in copy.inputFiles()}:
            at = path(folder)
            if at.getParent().toUri().getPath() == below:
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# Above this many rows a key or file list is joined by shuffle; below, at a few
# hundred bytes a row, it takes well under 100 MB on each executor.
MAX_BROADCAST_ROWS = 100_000


def pin_keys(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Pin a list of keys or files and, once counted to be small, have it broadcast to its joins.

    A longer list stays an ordinary join side, which Spark shuffles and splits where skewed."""
    pinned = pin(df)
    return F.broadcast(pinned) if pinned.limit(limit + 1).count() <= limit else pinned


# Above this many properties a list of their days is joined by shuffle, too: with five days each, one takes about 160 bytes.
MAX_BROADCAST_PROPERTIES = 500_000


def key_join(df: DataFrame, keys: DataFrame, on: tuple[str, ...], how: str) -> DataFrame:
    """Semi or anti join with a pinned list of keys, without moving the rows as long as the list can be broadcast.

    A list of days that is too long row by row goes as one row per property with its days."""
    keys = keys.select(*on)
    if len(on) != 2 or keys.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        return df.join(keys, list(on), how)
    prop, day = on
    if keys.select(prop).distinct().limit(MAX_BROADCAST_PROPERTIES + 1).count() > MAX_BROADCAST_PROPERTIES:
        return df.join(keys, list(on), how)
    days = keys.dropna().groupBy(F.col(prop).alias("_prop")).agg(F.collect_set(day).alias("_days"))
    match = (df[prop] == F.col("_prop")) & F.array_contains(F.col("_days"), df[day])
    return df.join(F.broadcast(days), match, how)
