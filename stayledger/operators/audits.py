"""Counts, coverage and freshness of any table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.session import scratch_path


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("NB_ROWS"))


def count_by_day(df: DataFrame, day: str) -> DataFrame:
    """Rows per property and day, newest day first."""
    return count_by(df, "PROPERTY", day).orderBy(F.col(day).desc(), "PROPERTY")


def coverage(df: DataFrame, day: str) -> DataFrame:
    """First day, last day and rows per property."""
    return (
        df.groupBy("PROPERTY")
        .agg(F.min(day).alias("MIN_DATE"), F.max(day).alias("MAX_DATE"), F.count(F.lit(1)).alias("NB_ROWS"))
        .orderBy("PROPERTY")
    )


def freshness(df: DataFrame, day: str) -> DataFrame:
    """Newest modification per property and day, newest day first within a property."""
    return (
        df.groupBy("PROPERTY", day)
        .agg(F.max("MODIFIED_AT").alias("MODIFIED_AT"))
        .orderBy("PROPERTY", F.col(day).desc())
    )


def top(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows, of the given order when one is named."""
    return (df.orderBy(*order) if order else df).limit(n)


def page(df: DataFrame, skip: int, take: int, *order: str) -> DataFrame:
    """Rows skip+1 .. skip+take of a total order, unknown values first.

    The rows are dealt into ranges of the order and stored by range; the ranges' counts tell where the page lies, and only
    the ranges it touches are read again and sorted.  The rows before it are counted, never sorted or carried along."""
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, at = scratch_path(spark, "pages"), "_range"
    dealt = df.repartitionByRange(ranges, *(F.col(c) for c in order)).withColumn(at, F.spark_partition_id())
    dealt.write.partitionBy(at).parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    before, touched, first = 0, [], skip
    for row in stored.groupBy(at).count().orderBy(at).collect():
        if before < skip + take and before + row["count"] > skip:
            first = skip - before if not touched else first
            touched.append(row[at])
        before += row["count"]
    return stored.filter(F.col(at).isin(touched)).drop(at).orderBy(*order).offset(first).limit(take)
