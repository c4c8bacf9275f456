"""The driver tables seen as bookings.

One lineitem is one reservation-night: the supplier is the property, the part
key spreads the report days, the line number places the night before or after
the report day.  Every lineitem row is kept.  A view joins only the tables that
the asked-for columns come from; the joins are left joins on primary keys, so
leaving one out changes no row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators import canonical, filters, marts
from stayledger.schemas import MONEY, STG_OPERA, STG_SMILE, conform
from stayledger.session import scratch_path

AS_OF = date(2024, 1, 6)
FIRST_DAY = date(2024, 1, 1)
CUTOFF = date(2024, 1, 5)
RESTORE = (date(2024, 1, 2), date(2024, 1, 8))
ABSENT_PROPERTY = "Supplier#000000003"
LOADED_PROPERTY = "Supplier#000000002"

# Columns that come from a table other than lineitem.
_FROM = {
    "PROPERTY": "supplier",
    "NATION": "supplier",
    "STATUS": "orders",
    "RATE_CODE": "orders",
    "BK_SOURCE": "orders",
    "CREATED_AT": "orders",
    "MODIFIED_AT": "orders",
    "MARKET": "customer",
    "ARR": "part",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def booking_base(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Reservation-nights; all columns, or just the named ones."""
    wanted = set(columns) or None

    def needs(source: str) -> bool:
        return wanted is None or any(_FROM.get(c) == source for c in wanted)

    df = table(spark, sf_dir, "lineitem")
    if needs("supplier"):
        df = df.join(
            table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
            "left",
        )
    if needs("part"):
        df = df.join(
            table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"),
            F.col("l_partkey") == F.col("p_partkey"),
            "left",
        )
    if needs("orders") or needs("customer"):
        orders = table(spark, sf_dir, "orders")
        if needs("customer"):
            # Orders take their segment first: the far smaller side of the later
            # lineitem join carries the customer column along.
            orders = orders.join(
                table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
                F.col("o_custkey") == F.col("c_custkey"),
                "left",
            )
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    report = F.date_add(F.lit(FIRST_DAY), (F.col("l_partkey") % 10).cast("int"))
    df = df.withColumn("REPORT_DATE", report)
    df = df.withColumn("STAYING", F.date_add("REPORT_DATE", F.col("l_linenumber") - 3))
    df = df.withColumn("ARRIVAL", F.date_sub("STAYING", (F.col("l_orderkey") % 3).cast("int")))
    lead = (F.lit(20) - F.col("l_orderkey") % 400).cast("int")
    money = F.col("l_extendedprice").cast(MONEY)
    exprs = {
        "FOLIONUM": F.col("l_orderkey").cast("int"),
        "DEPARTURE": F.date_add("ARRIVAL", 3),
        "CREATE_DATE": F.when(F.col("l_orderkey") % 97 != 0, F.date_add("ARRIVAL", lead)),
        "R_TYPE": F.col("l_returnflag"),
        "R_CHARGE": F.col("l_linestatus"),
        "N_OF_ROOM": F.col("l_quantity").cast("int"),
        "N_OF_ADT": F.col("l_linenumber").cast("int"),
        "N_OF_CHD": (F.col("l_orderkey") % 3).cast("int"),
        "COUNTRY": F.concat("l_returnflag", "l_linestatus"),
        "NATIONALITY": F.col("l_linestatus"),
        "RATE_AMT": F.col("l_extendedprice"),
        "ROOM_REV": money,
        "FB_REV": (money * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY),
        "OTHER_REV": F.when(
            F.col("l_discount") != 0, (money * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)
        ),
        "LAYOUT": F.when(F.col("l_suppkey") % 2 == 0, "SMILE").otherwise("OPERA"),
        "FILE_NAME": F.concat(F.lit("Pace_Date"), F.date_format("REPORT_DATE", "ddMMyyyy"), F.lit("_0930.xls")),
    }
    if needs("supplier"):
        exprs["PROPERTY"] = F.col("s_name")
        exprs["NATION"] = F.col("s_nationkey")
    if needs("orders"):
        exprs |= {
            "STATUS": F.col("o_orderstatus"),
            "RATE_CODE": F.col("o_orderpriority"),
            "BK_SOURCE": F.substring("o_orderpriority", 1, 1),
            "CREATED_AT": F.col("o_orderdate"),
            "MODIFIED_AT": F.col("o_orderdate"),
        }
    if needs("customer"):
        exprs["MARKET"] = F.col("c_mktsegment")
    if needs("part"):
        exprs["ARR"] = F.when(F.col("l_linenumber") != 7, F.col("p_retailprice").cast(MONEY))
    df = df.withColumns(exprs)
    names = columns or ("REPORT_DATE", "STAYING", "ARRIVAL", *exprs)
    return df.select(*names)


def smile_rows(base: DataFrame) -> DataFrame:
    """Base rows in the SMILE staging layout."""
    return conform(base.withColumn("CREATE_TIME", F.col("CREATE_DATE").cast("timestamp_ntz")), STG_SMILE)


def opera_names(base: DataFrame) -> DataFrame:
    """Base rows under Opera's column names, where ARR is the arrival date."""
    return base.drop("ARR").withColumnsRenamed(
        {
            "STAYING": "CONSIDERED_DATE",
            "ARRIVAL": "ARR",
            "DEPARTURE": "DEP",
            "CREATE_DATE": "CREATED_DATE",
            "MARKET": "MARKET_CODE",
            "R_TYPE": "ROOM_CAT",
            "R_CHARGE": "RTC",
            "ROOM_REV": "ROOM_REVENUE",
            "FB_REV": "FOOD_REVENUE",
            "OTHER_REV": "OTHER_REVENUE",
            "N_OF_ROOM": "NO_ROOMS",
            "N_OF_ADT": "ADULTS",
            "N_OF_CHD": "CHILDREN",
            "BK_SOURCE": "SOURCE_CODE",
            "STATUS": "CHANNEL",
            "FOLIONUM": "RESV_NAME_ID",
        }
    )


def opera_rows(base: DataFrame) -> DataFrame:
    """Base rows in the Opera staging layout."""
    return conform(opera_names(base), STG_OPERA)


def staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(SMILE staging, Opera staging): together every row of the base.

    A run reads staging several times, so it is written once to the shared
    folder, as stored staging tables would be, instead of joined again each time."""
    folder = scratch_path(spark, "staging")
    booking_base(spark, sf_dir).write.partitionBy("LAYOUT").parquet(folder)
    base = spark.read.parquet(folder)
    return (
        smile_rows(base.filter(F.col("LAYOUT") == "SMILE")),
        opera_rows(base.filter(F.col("LAYOUT") == "OPERA")),
    )


def canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in the canonical shape, read as SMILE."""
    return canonical.canonical_smile(smile_rows(booking_base(spark, sf_dir)))


def canon_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, joined once and kept in the shared folder by report day, in the order of the tables."""
    folder = scratch_path(spark, "canon")
    rows = canon(spark, sf_dir)
    rows.sortWithinPartitions("REPORT_DATE", "PROPERTY").write.partitionBy("REPORT_DATE").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.otb(canon(spark, sf_dir))


def detail_old(df: DataFrame) -> DataFrame:
    """An earlier state of a detail-like frame: last two days missing, one day in an older version."""
    stale = F.when(
        F.col("REPORT_DATE") == F.lit(date(2024, 1, 5)),
        F.col("MODIFIED_AT") - F.expr("INTERVAL 1 DAY"),
    ).otherwise(F.col("MODIFIED_AT"))
    return df.filter(F.col("REPORT_DATE") < F.lit(date(2024, 1, 9))).withColumn("MODIFIED_AT", stale)


def hist(df: DataFrame) -> DataFrame:
    """An earlier state of history: the past nights of odd days of the month."""
    nights = filters.past_night(df).drop("REPORT_DATE")
    return nights.filter(F.dayofmonth("STAYING") % 2 == 1)


def actual_old(history: DataFrame, mode: str = "clamped") -> DataFrame:
    """An earlier state of actual: one property missing."""
    return marts.pace_actual(history.filter(F.col("PROPERTY") != ABSENT_PROPERTY), mode=mode)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot file per event, as a listing would show it."""
    stamp = F.date_format("ts", "ddMMyyyy_HHmm")
    name = F.concat(F.lit("Pace "), "event_type", F.lit(" Date"), stamp, F.lit(".xls"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("PROPERTY"),
        F.col("event_id").alias("FILE_ID"),
        name.alias("NAME"),
        F.col("ts").alias("MODIFIED_AT"),
        F.col("ts").alias("CREATED_AT"),
    )
