"""Queries over whole runs: what a user calls."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators import filters
from stayledger.operators.canonical import (
    canonical_history_opera,
    canonical_history_smile,
    union_layouts,
)
from stayledger.operators.marts import pace_report, pace_report_legacy
from stayledger.plans import ledger as stored_runs
from stayledger.plans import marts
from stayledger.plans.audit import audit_summary, audit_tables
from stayledger.plans.rates import LAK_PAIRS, USD_PAIRS, lak_rates, refresh_rates, usd_rates
from stayledger.sinks.tables import TABLES, Ledger
from stayledger.sinks.versions import versions
from workload import views
from workload.mutations import RATES_SQL, landed_json, stored
from workload.projections import LEGACY_LABEL, LEGACY_SORT
from workload.registry import query
from workload.scans import html_pages
from workload.sql_views import ACTUAL_COLS, DETAIL_COLS, HIST_COLS, REPORT_COLS, actual_sql, changed_sql, report_sql


def _tagged(**frames: DataFrame) -> DataFrame:
    """Several marts under each other, told apart by MART; what one lacks is NULL."""
    parts = [df.withColumn("MART", F.lit(mart)) for mart, df in frames.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


_NO_DAY = "CAST(NULL AS DATE) AS REPORT_DATE"

# An earlier version of the marts over both layouts.
_BOTH = """
    b_detail AS (SELECT * FROM canon_both WHERE STAYING >= REPORT_DATE),
    b_detail_old AS (
        SELECT * REPLACE (CASE WHEN REPORT_DATE = DATE '2024-01-05' THEN MODIFIED_AT - INTERVAL 1 DAY
                               ELSE MODIFIED_AT END AS MODIFIED_AT)
        FROM b_detail WHERE REPORT_DATE < DATE '2024-01-09'),
    b_hist AS (SELECT * EXCLUDE (REPORT_DATE) FROM canon_both
               WHERE STAYING = REPORT_DATE - 1 AND date_part('day', STAYING) % 2 = 1)
"""
# Change list with the last loaded day as "today", so that last night changes too.
_KEYS = f"keys AS ({changed_sql('canon_both', 'b_detail_old')})"
_TODAY = "DATE '2024-01-09'"
TODAY = views.FIRST_DAY + timedelta(days=8)


def _new_detail(keys: str = "keys") -> str:
    return f"""
        SELECT * FROM b_detail_old t WHERE NOT EXISTS (
            SELECT 1 FROM {keys} k WHERE k.PROPERTY = t.PROPERTY AND k.REPORT_DATE = t.REPORT_DATE)
        UNION ALL
        SELECT * FROM b_detail d WHERE EXISTS (
            SELECT 1 FROM {keys} k WHERE k.PROPERTY = d.PROPERTY AND k.REPORT_DATE = d.REPORT_DATE)
    """


_NEW_HISTORY = f"""
    SELECT {HIST_COLS} FROM b_hist h WHERE NOT EXISTS (
        SELECT 1 FROM keys k WHERE k.REPORT_DATE = {_TODAY} AND k.PROPERTY = h.PROPERTY AND h.STAYING = k.REPORT_DATE - 1)
    UNION ALL
    SELECT {HIST_COLS} FROM canon_both c WHERE c.REPORT_DATE = {_TODAY} AND c.STAYING = c.REPORT_DATE - 1
      AND EXISTS (SELECT 1 FROM keys k WHERE k.PROPERTY = c.PROPERTY AND k.REPORT_DATE = c.REPORT_DATE)
"""


@query(
    "pipe_detail_full",
    f"""SELECT 'detail' AS MART, {DETAIL_COLS} FROM canon_both WHERE STAYING >= REPORT_DATE
        UNION ALL
        SELECT 'history', {_NO_DAY}, {HIST_COLS} FROM canon_both
        WHERE REPORT_DATE = DATE '2024-01-06' AND STAYING = REPORT_DATE - 1""",
)
def pipe_detail_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = marts.detail_full(*views.staging(spark, sf_dir), views.AS_OF)
    return _tagged(detail=made.detail, history=made.history)


@query(
    "pipe_detail_incremental",
    f"""WITH {_BOTH}, {_KEYS}
        SELECT 'detail' AS MART, {DETAIL_COLS} FROM ({_new_detail()})
        UNION ALL SELECT 'history', {_NO_DAY}, {HIST_COLS} FROM ({_NEW_HISTORY})""",
)
def pipe_detail_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    smile, opera = views.staging(spark, sf_dir)
    canon = union_layouts(smile, opera)
    made = marts.detail_incremental(smile, opera, views.detail_old(filters.otb(canon)), views.hist(canon), TODAY)
    return _tagged(detail=made.detail, history=made.history)


@query(
    "pipe_report_full",
    f"""SELECT 'report' AS MART, {REPORT_COLS} FROM ({report_sql('detail')})
        UNION ALL SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM ({actual_sql('hist')})""",
)
def pipe_report_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = views.canon(spark, sf_dir)
    made = marts.report_full(filters.otb(canon), views.hist(canon))
    return _tagged(report=made.report, actual=made.actual)


@query(
    "pipe_report_incremental",
    f"""WITH old_report AS ({report_sql('detail_old')}),
        stale AS ({changed_sql('detail', 'old_report')}),
        kept AS (SELECT * FROM actual_old WHERE STAYING_DATE IS DISTINCT FROM DATE '2024-01-05')
        SELECT 'report' AS MART, {REPORT_COLS} FROM old_report r WHERE NOT EXISTS (
            SELECT 1 FROM stale k WHERE k.PROPERTY = r.PROPERTY AND k.REPORT_DATE = r.REPORT_DATE)
        UNION ALL
        SELECT 'report', {REPORT_COLS} FROM ({report_sql('''(SELECT x.* FROM detail x JOIN stale k
            ON x.PROPERTY = k.PROPERTY AND x.REPORT_DATE = k.REPORT_DATE)''')})
        UNION ALL
        SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM kept
        UNION ALL
        SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM ({actual_sql('''(SELECT * FROM hist h WHERE NOT EXISTS (
            SELECT 1 FROM kept a WHERE a.PROPERTY = h.PROPERTY AND a.STAYING_DATE = h.STAYING))''')})""",
)
def pipe_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = views.canon(spark, sf_dir)
    detail, history = filters.otb(canon), views.hist(canon)
    made = marts.report_incremental(
        detail, history, pace_report(views.detail_old(detail)), views.actual_old(history), views.AS_OF
    )
    return _tagged(report=made.report, actual=made.actual)


_LEGACY_COLS = (
    'REPORT_DATE, STAYING_DATE, PROPERTY, MARKET, R_TYPE, R_CHARGE, "WINDOW", WINDOW_SORT, TOTAL_ROOM, ROOM_REV, ARR, '
    "CREATED_AT, MODIFIED_AT"
)


def _legacy_sql(source: str) -> str:
    return f"""
        SELECT REPORT_DATE, STAYING AS STAYING_DATE, PROPERTY, MARKET, R_TYPE, R_CHARGE, {LEGACY_LABEL} AS "WINDOW",
            CAST({LEGACY_SORT} AS INTEGER) AS WINDOW_SORT, CAST(SUM(N_OF_ROOM) AS INTEGER) AS TOTAL_ROOM,
            CAST(SUM(ROOM_REV) AS DECIMAL(18,2)) AS ROOM_REV, CAST(SUM(ARR) AS DECIMAL(18,2)) AS ARR,
            MAX(CREATED_AT) AS CREATED_AT, MAX(MODIFIED_AT) AS MODIFIED_AT
        FROM {source} GROUP BY ALL
    """


@query(
    "pipe_report_rolling7",
    f"""SELECT {_LEGACY_COLS} FROM ({_legacy_sql('detail_old')}) WHERE REPORT_DATE < DATE '2024-01-03'
        UNION ALL SELECT {_LEGACY_COLS} FROM ({_legacy_sql("(SELECT * FROM detail WHERE REPORT_DATE >= DATE '2024-01-03')")})""",
)
def pipe_report_rolling7(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = views.detail(spark, sf_dir)
    report = pace_report_legacy(views.detail_old(detail))
    return marts.report_rolling(detail, report, views.FIRST_DAY + timedelta(days=9))


@query(
    "pipe_history_full",
    f"""WITH {_BOTH},
        file_rows AS ({{HISTORY}}),
        loaded AS (
            SELECT {HIST_COLS} FROM b_hist WHERE PROPERTY <> '{views.LOADED_PROPERTY}'
            UNION ALL SELECT {HIST_COLS} FROM file_rows WHERE STAYING <= DATE '2024-01-05'),
        old_actual AS ({actual_sql("(SELECT * FROM b_hist WHERE PROPERTY <> 'Supplier#000000003')")})
        SELECT 'history' AS MART, CAST(NULL AS DATE) AS STAYING_DATE, CAST(NULL AS INTEGER) AS WINDOW_ID,
            CAST(NULL AS INTEGER) AS TOTAL_ROOM, CAST(NULL AS INTEGER) AS TOTAL_BOOKING, {HIST_COLS} FROM loaded
        UNION ALL BY NAME
        SELECT 'actual' AS MART, {ACTUAL_COLS} FROM old_actual
        WHERE NOT (PROPERTY = '{views.LOADED_PROPERTY}' AND STAYING_DATE <= DATE '2024-01-05')
        UNION ALL BY NAME
        SELECT 'actual' AS MART, {ACTUAL_COLS} FROM ({actual_sql(f'''(SELECT * FROM loaded
            WHERE PROPERTY = '{views.LOADED_PROPERTY}' AND STAYING <= DATE '2024-01-05')''', strict=True)})""".replace(
        "{HISTORY}",
        f"""SELECT * REPLACE (CAST(ARR + ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS TOTAL_TURN_OVER)
            FROM canon WHERE PROPERTY = '{views.LOADED_PROPERTY}'""",
    ),
)
def pipe_history_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One property's history file, which holds every one of its nights."""
    smile, opera = views.staging(spark, sf_dir)
    history = views.hist(union_layouts(smile, opera))
    rows = canonical_history_smile(smile.filter(F.col("PROPERTY") == views.LOADED_PROPERTY))
    made = marts.load_history_full(history, views.actual_old(history), rows, views.LOADED_PROPERTY, views.CUTOFF)
    return _tagged(history=made.history, actual=made.actual)


@query(
    "pipe_history_incremental",
    f"""WITH {_BOTH}, file_rows AS (
            SELECT {HIST_COLS} FROM (
                SELECT * REPLACE (CAST(ARR + ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS TOTAL_TURN_OVER) FROM canon)
            JOIN layouts USING (PROPERTY) WHERE LAYOUT = 'SMILE'
            UNION ALL
            SELECT {HIST_COLS} FROM (
                SELECT * REPLACE (CAST(ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS TOTAL_TURN_OVER) FROM canon_opera)
            JOIN layouts USING (PROPERTY) WHERE LAYOUT = 'OPERA')
        SELECT {HIST_COLS} FROM b_hist
        UNION ALL SELECT {HIST_COLS} FROM file_rows f WHERE NOT EXISTS (
            SELECT 1 FROM b_hist h WHERE h.PROPERTY = f.PROPERTY AND h.STAYING = f.STAYING)""",
)
def pipe_history_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History files of every property."""
    smile, opera = views.staging(spark, sf_dir)
    rows = canonical_history_smile(smile).unionByName(canonical_history_opera(opera))
    return marts.load_history_incremental(views.hist(union_layouts(smile, opera)), rows)


@query(
    "pipe_restore_history",
    f"""WITH {_BOTH},
        filled AS (SELECT {HIST_COLS} FROM b_hist
            UNION ALL SELECT {HIST_COLS} FROM canon_both c
            WHERE REPORT_DATE >= DATE '2024-01-02' AND REPORT_DATE <= DATE '2024-01-08' AND STAYING = REPORT_DATE - 1
              AND NOT EXISTS (SELECT 1 FROM b_hist h WHERE h.PROPERTY = c.PROPERTY AND h.STAYING = c.STAYING)),
        old_actual AS ({actual_sql("(SELECT * FROM b_hist WHERE PROPERTY <> 'Supplier#000000003')", strict=True)})
        SELECT 'history' AS MART, {HIST_COLS} FROM filled
        UNION ALL BY NAME SELECT 'actual' AS MART, {ACTUAL_COLS} FROM old_actual
        UNION ALL BY NAME SELECT 'actual' AS MART, {ACTUAL_COLS} FROM ({actual_sql('''(SELECT * FROM filled f
            WHERE STAYING + 1 >= DATE '2024-01-02' AND STAYING + 1 <= DATE '2024-01-08' AND NOT EXISTS (
                SELECT 1 FROM old_actual a WHERE a.PROPERTY = f.PROPERTY AND a.STAYING_DATE = f.STAYING))''', strict=True)})""",
)
def pipe_restore_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    smile, opera = views.staging(spark, sf_dir)
    history = views.hist(union_layouts(smile, opera))
    made = marts.restore(smile, opera, history, views.actual_old(history, "strict"), *views.RESTORE)
    return _tagged(history=made.history, actual=made.actual)


@query("pipe_fx_usd", f"WITH {RATES_SQL} SELECT * FROM fresh")
def pipe_fx_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice: the days' pair is replaced, so the second run changes nothing."""
    ledger, landed = stored(spark, "exchange_rate"), landed_json(spark, sf_dir)
    for _ in range(2):
        refresh_rates(ledger, usd_rates(landed), landed, USD_PAIRS)
    return ledger.table("exchange_rate")


# Later pages lack a pair on every third day and have no rates at all on every fifth.
_LATE_LAK = "date_part('day', REPORT_DATE) % 5 > 0 AND (date_part('day', REPORT_DATE) % 3 > 0 OR FROM_CURRENCY_CODE = 'USD')"


@query("pipe_fx_lak", f"WITH {RATES_SQL} SELECT * FROM lak WHERE {_LATE_LAK}")
def pipe_fx_lak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice; what the second pages lack is gone."""
    ledger, pages = stored(spark, "exchange_rate"), html_pages(spark, sf_dir)
    refresh_rates(ledger, lak_rates(pages), pages, LAK_PAIRS)
    day = F.dayofmonth("REPORT_DATE")
    html = F.when(day % 5 == 0, "<html>closed</html>").when(day % 3 == 0, F.replace("HTML", F.lit("VND/LAK"), F.lit("LAK")))
    later = pages.withColumn("HTML", F.coalesce(html, "HTML"))
    refresh_rates(ledger, lak_rates(later), later, LAK_PAIRS)
    return ledger.table("exchange_rate")


@query(
    "pipe_run_full",
    f"""WITH {_BOTH}, last_night AS (SELECT * EXCLUDE (REPORT_DATE) FROM canon_both
            WHERE REPORT_DATE = DATE '2024-01-06' AND STAYING = REPORT_DATE - 1)
        SELECT 'report' AS MART, {REPORT_COLS} FROM ({report_sql('b_detail')})
        UNION ALL SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM ({actual_sql('last_night')})""",
)
def pipe_run_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = marts.run_full(*views.staging(spark, sf_dir), views.AS_OF)
    return _tagged(report=made.report, actual=made.actual)


_RUN_INCREMENTAL_SQL = f"""
    WITH {_BOTH}, {_KEYS},
    n_detail AS ({_new_detail()}),
    n_hist AS ({_NEW_HISTORY}),
    o_actual AS ({actual_sql("(SELECT * FROM b_hist WHERE PROPERTY <> 'Supplier#000000003')")}),
    kept AS (SELECT * FROM o_actual WHERE STAYING_DATE IS DISTINCT FROM {_TODAY} - 1)
    SELECT 'report' AS MART, {REPORT_COLS} FROM ({report_sql('n_detail')})
    UNION ALL SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM kept
    UNION ALL SELECT 'actual', {_NO_DAY}, {ACTUAL_COLS} FROM ({actual_sql('''(SELECT * FROM n_hist h WHERE NOT EXISTS (
        SELECT 1 FROM kept a WHERE a.PROPERTY = h.PROPERTY AND a.STAYING_DATE = h.STAYING))''')})
"""


@query("pipe_run_incremental", _RUN_INCREMENTAL_SQL)
def pipe_run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    smile, opera = views.staging(spark, sf_dir)
    canon = union_layouts(smile, opera)
    detail, history = views.detail_old(filters.otb(canon)), views.hist(canon)
    old = marts.Marts(detail, history, pace_report(detail), views.actual_old(history))
    made = marts.run_incremental(smile, opera, old, TODAY)
    return _tagged(report=made.report, actual=made.actual)


_TABLES = (
    "stg_smile",
    "stg_opera",
    "booking_pace_detail",
    "booking_pace_history",
    "booking_pace_report",
    "booking_pace_actual",
)


def _staged(spark: SparkSession, sf_dir: str) -> tuple[Ledger, DataFrame]:
    """Fresh tables with staging filled, and its rows in the canonical shape."""
    ledger = stored(spark, *_TABLES)
    base = views.booking_base(spark, sf_dir)
    for table, layout, shaped in (("stg_smile", "SMILE", views.smile_rows), ("stg_opera", "OPERA", views.opera_rows)):
        # The base has few days, so a task's rows make few files, however they are dealt.
        rows = shaped(base.filter(F.col("LAYOUT") == layout)).sortWithinPartitions("REPORT_DATE", "PROPERTY")
        ledger.append(table, rows, placed=True)
    return ledger, union_layouts(ledger.table("stg_smile"), ledger.table("stg_opera"))


@query("pipe_detail_full_stored", like="pipe_detail_full")
def pipe_detail_full_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuild on stored tables, over what an earlier one left."""
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_detail", views.detail_old(filters.otb(canon)), placed=True)
    stored_runs.refresh_detail_full(ledger, views.AS_OF)
    return _tagged(detail=ledger.table("booking_pace_detail"), history=ledger.table("booking_pace_history"))


@query("pipe_report_full_stored", like="pipe_report_full")
def pipe_report_full_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, canon = stored(spark, *_TABLES), views.canon(spark, sf_dir)
    ledger.append("booking_pace_detail", filters.otb(canon))
    ledger.append("booking_pace_history", views.hist(canon))
    stored_runs.refresh_report_full(ledger)
    return _tagged(report=ledger.table("booking_pace_report"), actual=ledger.table("booking_pace_actual"))


@query("pipe_detail_incremental_stored", like="pipe_detail_incremental")
def pipe_detail_incremental_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change list comes from the tables' day versions; only changed days are read and written."""
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_detail", views.detail_old(filters.otb(canon)), placed=True)
    ledger.append("booking_pace_history", views.hist(canon))
    stored_runs.refresh_detail_incremental(ledger, TODAY)
    return _tagged(detail=ledger.table("booking_pace_detail"), history=ledger.table("booking_pace_history"))


@query("pipe_report_incremental_stored", like="pipe_report_incremental")
def pipe_report_incremental_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed days and missing nights come from the tables' day versions."""
    ledger, canon = stored(spark, *_TABLES), views.canon(spark, sf_dir)
    detail = filters.otb(canon)
    ledger.append("booking_pace_detail", detail)
    ledger.append("booking_pace_history", views.hist(canon))
    ledger.append("booking_pace_report", pace_report(views.detail_old(detail)))
    ledger.append("booking_pace_actual", views.actual_old(ledger.table("booking_pace_history")))
    stored_runs.refresh_report_incremental(ledger, views.AS_OF)
    return _tagged(report=ledger.table("booking_pace_report"), actual=ledger.table("booking_pace_actual"))


_VERSION_COLS = "PROPERTY, {day} AS DAY, CAST(COUNT(*) AS BIGINT) AS NB_ROWS, MAX(MODIFIED_AT) AS MODIFIED_AT"


@query(
    "agg_day_versions",
    f"""WITH {_BOTH}, {_KEYS}, n_detail AS ({_new_detail()})
        SELECT 'booking_pace_detail' AS TABLE_NAME, {_VERSION_COLS.format(day='REPORT_DATE')} FROM n_detail GROUP BY PROPERTY, REPORT_DATE
        UNION ALL
        SELECT 'booking_pace_history', {_VERSION_COLS.format(day='STAYING')} FROM ({_NEW_HISTORY}) GROUP BY PROPERTY, STAYING""",
)
def agg_day_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the day versions say of detail and history: made before a run, brought up to date after it."""
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_detail", views.detail_old(filters.otb(canon)), placed=True)
    ledger.append("booking_pace_history", views.hist(canon))
    stored_runs.refresh_detail_incremental(ledger, TODAY)
    told = (
        versions(ledger, t).select(F.lit(t).alias("TABLE_NAME"), "PROPERTY", F.col(TABLES[t].day).alias("DAY"), "NB_ROWS", "MODIFIED_AT")
        for t in ("booking_pace_detail", "booking_pace_history")
    )
    return reduce(DataFrame.unionByName, told)


_STORED_SUMMARY = """
    SELECT MART, PROPERTY, MIN(DAY) AS MIN_DATE, MAX(DAY) AS MAX_DATE, CAST(COUNT(*) AS BIGINT) AS NB_ROWS,
        CAST(COUNT(*) FILTER (DAY IS NULL) AS BIGINT) AS NULL_DATES, MAX(MODIFIED_AT) AS MODIFIED_AT
    FROM (SELECT 'booking_pace_detail' AS MART, PROPERTY, REPORT_DATE AS DAY, MODIFIED_AT FROM detail
          UNION ALL SELECT 'booking_pace_history', PROPERTY, CASE WHEN N_OF_ROOM > 5 THEN STAYING END, MODIFIED_AT FROM hist)
    GROUP BY MART, PROPERTY
"""


@query("pipe_audit_stored", _STORED_SUMMARY)
def pipe_audit_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of stored tables from their day versions; rows without a night are counted from their partition."""
    ledger, canon = stored(spark, *_TABLES), views.canon(spark, sf_dir)
    ledger.append("booking_pace_detail", filters.otb(canon))
    ledger.append("booking_pace_history", views.hist(canon).withColumn("STAYING", F.when(F.col("N_OF_ROOM") > 5, F.col("STAYING"))))
    return audit_tables(ledger, {"booking_pace_detail": "REPORT_DATE", "booking_pace_history": "STAYING"})


@query("pipe_restore_history_stored", like="pipe_restore_history")
def pipe_restore_history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_history", views.hist(canon))
    ledger.append("booking_pace_actual", views.actual_old(ledger.table("booking_pace_history"), "strict"))
    stored_runs.restore(ledger, *views.RESTORE)
    return _tagged(history=ledger.table("booking_pace_history"), actual=ledger.table("booking_pace_actual"))


@query("pipe_history_full_stored", like="pipe_history_full")
def pipe_history_full_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_history", views.hist(canon))
    ledger.append("booking_pace_actual", views.actual_old(ledger.table("booking_pace_history")))
    smile = views.smile_rows(views.booking_base(spark, sf_dir)).filter(F.col("PROPERTY") == views.LOADED_PROPERTY)
    stored_runs.load_history_full(ledger, canonical_history_smile(smile), views.CUTOFF)
    return _tagged(history=ledger.table("booking_pace_history"), actual=ledger.table("booking_pace_actual"))


@query("pipe_history_incremental_stored", like="pipe_history_incremental")
def pipe_history_incremental_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_history", views.hist(canon))
    rows = canonical_history_smile(ledger.table("stg_smile"))
    rows = rows.unionByName(canonical_history_opera(ledger.table("stg_opera")))
    stored_runs.load_history_incremental(ledger, rows)
    return ledger.table("booking_pace_history")


@query("pipe_run_incremental_stored", _RUN_INCREMENTAL_SQL)
def pipe_run_incremental_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run on stored tables, where only changed days are written."""
    ledger, canon = _staged(spark, sf_dir)
    ledger.append("booking_pace_detail", views.detail_old(filters.otb(canon)), placed=True)
    ledger.append("booking_pace_history", views.hist(canon))
    ledger.append("booking_pace_report", pace_report(ledger.table("booking_pace_detail")))
    ledger.append("booking_pace_actual", views.actual_old(ledger.table("booking_pace_history")))
    stored_runs.run_incremental(ledger, TODAY)
    return _tagged(report=ledger.table("booking_pace_report"), actual=ledger.table("booking_pace_actual"))


@query(
    "pipe_audit",
    """WITH days AS (
           SELECT 'detail' AS MART, PROPERTY, REPORT_DATE AS DAY, MODIFIED_AT FROM detail
           UNION ALL SELECT 'history', PROPERTY, STAYING, MODIFIED_AT FROM hist
           UNION ALL SELECT 'staging', PROPERTY, CREATE_DATE, MODIFIED_AT FROM canon)
       SELECT MART, PROPERTY, MIN(DAY) AS MIN_DATE, MAX(DAY) AS MAX_DATE, CAST(COUNT(*) AS BIGINT) AS NB_ROWS,
              CAST(COUNT(*) FILTER (DAY IS NULL) AS BIGINT) AS NULL_DATES, MAX(MODIFIED_AT) AS MODIFIED_AT
       FROM days GROUP BY MART, PROPERTY""",
)
def pipe_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.booking_base(spark, sf_dir, "PROPERTY", "REPORT_DATE", "STAYING", "CREATE_DATE", "MODIFIED_AT")
    return audit_summary(
        {
            "detail": (filters.otb(rows), "REPORT_DATE"),
            "history": (views.hist(rows), "STAYING"),
            "staging": (rows, "CREATE_DATE"),
        }
    )
