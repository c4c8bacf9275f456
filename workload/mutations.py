"""Queries over table mutations, as pure functions and on stored tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators import changes, filters
from stayledger.operators.marts import pace_actual
from stayledger.operators.snapshots import latest_per_day, with_smile_name
from stayledger.plans.rates import USD_PAIRS, lak_rates, replace_rates, usd_rates
from stayledger.session import pin_keys, scratch_path
from stayledger.sinks.manifest import manifest_rows
from stayledger.sinks.tables import TABLES, Ledger
from workload import views
from workload.registry import query
from workload.scans import html_pages, json_payloads
from workload.sql_views import ACTUAL_COLS, DETAIL_COLS, HIST_COLS, actual_sql

_DETAIL = "booking_pace_detail"


def stored(spark: SparkSession, *tables: str) -> Ledger:
    """Fresh tables below the shared folder."""
    ledger = Ledger(spark, "w_" + uuid.uuid4().hex[:12])
    ledger.create(scratch_path(spark, "ledger"), {t: TABLES[t] for t in tables})
    return ledger


_STG_SQL = """
    SELECT FOLIONUM, ARRIVAL, DEPARTURE, STAYING, CAST(CREATE_DATE AS TIMESTAMP) AS CREATE_TIME,
        CAST(NULL AS VARCHAR) AS GROUP_CODE, CAST(NULL AS VARCHAR) AS GROUP_NAME, CAST(NULL AS VARCHAR) AS TA,
        CAST(NULL AS INTEGER) AS TA_ID, CAST(NULL AS VARCHAR) AS GUEST_NAME, MARKET, RATE_CODE, RATE_AMT,
        CAST(NULL AS VARCHAR) AS PACKAGE_CODE, CAST(NULL AS DECIMAL(18,2)) AS PACKAGE_AMOUNT, ARR, ROOM_REV, FB_REV,
        OTHER_REV, STATUS, R_TYPE, R_CHARGE, CAST(NULL AS VARCHAR) AS R_SURCHARGE, N_OF_ROOM, N_OF_ADT, N_OF_CHD,
        BK_SOURCE, COUNTRY, NATIONALITY, CAST(NULL AS DECIMAL(18,2)) AS TOTAL_TURN_OVER, CREATED_AT, MODIFIED_AT,
        FILE_NAME, PROPERTY, REPORT_DATE
    FROM bk_base
"""


@query("sink_create_table", _STG_SQL)
def sink_create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables are created; the staging one is then filled and read back."""
    ledger = stored(spark, *TABLES)
    ledger.append("stg_smile", views.smile_rows(views.booking_base(spark, sf_dir)))
    return ledger.table("stg_smile")


@query("sink_append", f"SELECT {DETAIL_COLS} FROM detail UNION ALL SELECT {DETAIL_COLS} FROM detail_old")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = stored(spark, _DETAIL)
    detail = views.detail(spark, sf_dir)
    ledger.append(_DETAIL, detail)
    ledger.append(_DETAIL, views.detail_old(detail))
    return ledger.table(_DETAIL)


@query("sink_truncate_load", f"SELECT {DETAIL_COLS} FROM detail")
def sink_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = stored(spark, _DETAIL)
    detail = views.detail(spark, sf_dir)
    ledger.append(_DETAIL, views.detail_old(detail))
    ledger.truncate_load(_DETAIL, detail)
    return ledger.table(_DETAIL)


@query(
    "sink_replace_day",
    f"""SELECT {DETAIL_COLS} FROM detail_old
        WHERE NOT (PROPERTY = '{views.LOADED_PROPERTY}' AND REPORT_DATE = DATE '2024-01-05')
        UNION ALL
        SELECT {DETAIL_COLS} FROM detail
        WHERE PROPERTY = '{views.LOADED_PROPERTY}' AND REPORT_DATE = DATE '2024-01-05'""",
)
def sink_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = date(2024, 1, 5)
    detail = views.detail(spark, sf_dir)
    new = detail.filter((F.col("PROPERTY") == views.LOADED_PROPERTY) & (F.col("REPORT_DATE") == F.lit(day)))
    return changes.replace_day(views.detail_old(detail), views.LOADED_PROPERTY, day, new)


_REPLACE_SQL = f"""
    SELECT {DETAIL_COLS} FROM detail_old t
    WHERE NOT EXISTS (SELECT 1 FROM changed k WHERE k.PROPERTY = t.PROPERTY AND k.REPORT_DATE = t.REPORT_DATE)
    UNION ALL
    SELECT {DETAIL_COLS} FROM detail d
    WHERE EXISTS (SELECT 1 FROM changed k WHERE k.PROPERTY = d.PROPERTY AND k.REPORT_DATE = d.REPORT_DATE)
"""


@query("sink_replace_keys", _REPLACE_SQL)
def sink_replace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = views.canon(spark, sf_dir)
    detail = filters.otb(canon)
    old = views.detail_old(detail)
    keys = pin_keys(changes.changed_keys(canon, old))
    return changes.replace_keys(old, keys, changes.restrict_to_keys(detail, keys, pinned=True), pinned=True)


@query("sink_replace_keys_stored", _REPLACE_SQL)
def sink_replace_keys_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table: only the changed days are written."""
    ledger = stored(spark, _DETAIL)
    canon = views.canon_by_day(spark, sf_dir)
    detail = filters.otb(canon)
    ledger.append(_DETAIL, views.detail_old(detail), placed=True)
    keys = pin_keys(changes.changed_keys(canon, ledger.table(_DETAIL)))
    ledger.replace_keys(_DETAIL, keys, changes.restrict_to_keys(detail, keys, pinned=True), placed=True)
    return ledger.table(_DETAIL)


_NIGHTS_SQL = "(SELECT * FROM canon WHERE STAYING = REPORT_DATE - 1)"


@query(
    "sink_delete_shifted_keys",
    f"""SELECT {HIST_COLS} FROM {_NIGHTS_SQL} h
        WHERE NOT EXISTS (SELECT 1 FROM changed k WHERE k.REPORT_DATE = DATE '2024-01-05'
                          AND k.PROPERTY = h.PROPERTY AND h.STAYING = k.REPORT_DATE - 1)""",
)
def sink_delete_shifted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = views.canon(spark, sf_dir)
    keys = changes.changed_keys(canon, views.detail_old(filters.otb(canon)))
    history = filters.past_night(canon).drop("REPORT_DATE")
    return changes.delete_shifted_keys(history, keys, date(2024, 1, 5))


@query(
    "sink_delete_cutoff",
    f"""SELECT 'up to' AS DELETED, {HIST_COLS} FROM hist
        WHERE NOT coalesce(PROPERTY = '{views.LOADED_PROPERTY}' AND STAYING <= DATE '2024-01-05', FALSE)
        UNION ALL
        SELECT 'after', {HIST_COLS} FROM hist
        WHERE NOT coalesce(PROPERTY = '{views.LOADED_PROPERTY}' AND STAYING > DATE '2024-01-05', FALSE)""",
)
def sink_delete_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = views.hist(views.canon(spark, sf_dir))
    before = changes.delete_up_to(history, views.LOADED_PROPERTY, views.CUTOFF, "STAYING")
    after = changes.delete_after(history, views.LOADED_PROPERTY, views.CUTOFF, "STAYING")
    return before.withColumn("DELETED", F.lit("up to")).unionByName(after.withColumn("DELETED", F.lit("after")))


@query(
    "sink_delete_day",
    f"""SELECT {ACTUAL_COLS} FROM ({actual_sql("hist")}) WHERE STAYING_DATE IS DISTINCT FROM DATE '2024-01-05'""",
)
def sink_delete_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.delete_night(pace_actual(views.hist(views.canon(spark, sf_dir))), views.AS_OF)


RATES_SQL = """
    fresh AS (
        SELECT CAST(ts AS DATE) AS REPORT_DATE, 'USD' AS FROM_CURRENCY_CODE, 'VND' AS TO_CURRENCY_CODE,
               CAST(k AS DECIMAL(18,4)) AS BUY_CASH, CAST(k + 1 AS DECIMAL(18,4)) AS BUY_TRANSFER,
               CAST(k + 2 AS DECIMAL(18,4)) AS SELL_CASH, CAST(k + 2 AS DECIMAL(18,4)) AS SELL_TRANSFER,
               ts AS CREATED_AT, ts AS MODIFIED_AT
        FROM (SELECT ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
    lak AS (
        SELECT CAST(ts AS DATE) AS REPORT_DATE, 'USD' AS FROM_CURRENCY_CODE, 'LAK' AS TO_CURRENCY_CODE,
               CAST('21' || k AS DECIMAL(18,4)) AS BUY_CASH, CAST('22' || k AS DECIMAL(18,4)) AS BUY_TRANSFER,
               CAST(k AS DECIMAL(18,4)) AS SELL_CASH,
               CAST(21650 AS DECIMAL(18,4)) AS SELL_TRANSFER, ts AS CREATED_AT, ts AS MODIFIED_AT
        FROM (SELECT ts, json_extract_string(props, '$.k') AS k FROM events)
        UNION ALL
        SELECT CAST(ts AS DATE), 'VND', 'LAK', CAST('0.' || k AS DECIMAL(18,4)), CAST(0.85 AS DECIMAL(18,4)),
               CAST('0.' || k || '1' AS DECIMAL(18,4)), NULL, ts, ts
        FROM (SELECT ts, json_extract_string(props, '$.k') AS k FROM events))
"""


@query(
    "sink_replace_rates",
    f"""WITH {RATES_SQL},
        stored AS (SELECT * FROM lak UNION ALL
                   SELECT * REPLACE (CAST(0 AS DECIMAL(18,4)) AS BUY_CASH) FROM fresh),
        late AS (SELECT * FROM fresh WHERE REPORT_DATE >= DATE '2024-01-15')
        SELECT * FROM stored s WHERE NOT EXISTS (
            SELECT 1 FROM late f WHERE f.REPORT_DATE = s.REPORT_DATE
              AND f.FROM_CURRENCY_CODE = s.FROM_CURRENCY_CODE AND f.TO_CURRENCY_CODE = s.TO_CURRENCY_CODE)
        UNION ALL SELECT * FROM late""",
)
def sink_replace_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rates table whose dollar rows of the later days are replaced; the kip rows stay."""
    usd = usd_rates(landed_json(spark, sf_dir))
    zero = F.lit(0).cast("decimal(18,4)")
    table = lak_rates(html_pages(spark, sf_dir)).unionByName(usd.withColumn("BUY_CASH", zero))
    late = usd.filter(F.col("REPORT_DATE") >= F.lit(date(2024, 1, 15)))
    return replace_rates(table, late, late, USD_PAIRS)


def landed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_payloads(spark, sf_dir).select(
        F.to_date("ts").alias("REPORT_DATE"),
        "PAYLOAD",
        F.col("ts").alias("CREATED_AT"),
        F.col("ts").alias("MODIFIED_AT"),
    )


@query(
    "sink_archive_manifest",
    """WITH named AS (SELECT *, CAST(MODIFIED_AT AS DATE) AS REPORT_DATE, date_trunc('minute', MODIFIED_AT) AS REPORT_AT,
               row_number() OVER (PARTITION BY PROPERTY, CAST(MODIFIED_AT AS DATE)
                   ORDER BY date_trunc('minute', MODIFIED_AT) DESC, MODIFIED_AT DESC, NAME DESC) AS rn FROM files)
       SELECT PROPERTY, NAME, 'LOADED' AS STATUS, CAST(NULL AS VARCHAR) AS REASON, REPORT_AT, MODIFIED_AT, REPORT_DATE
       FROM named n WHERE EXISTS (SELECT 1 FROM named g WHERE g.rn = 1 AND g.PROPERTY = n.PROPERTY
                                  AND g.REPORT_DATE = n.REPORT_DATE AND g.PROPERTY <> 'error')
       UNION ALL
       SELECT PROPERTY, NAME, 'FAILED', 'missing columns: ARR', REPORT_AT, MODIFIED_AT, REPORT_DATE
       FROM named WHERE rn = 1 AND PROPERTY = 'error'""",
)
def sink_archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a loaded day is done; the newest files of one property could not be read."""
    files = with_smile_name(views.files(spark, sf_dir))
    chosen = latest_per_day(files)
    failed = chosen.filter(F.col("PROPERTY") == "error").withColumn("REASON", F.lit("missing columns: ARR"))
    return manifest_rows(files, chosen.filter(F.col("PROPERTY") != "error"), failed)
