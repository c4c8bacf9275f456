"""Queries over joins, aggregates, orders, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.money import booking_flag
from stayledger.operators import audits, canonical, changes, filters, marts, snapshots
from stayledger.operators.lead_windows import STRICT, add_lead_window
from stayledger.plans.staging import Layout, from_delimited
from stayledger.session import scratch_path
from stayledger.sources.files import list_files
from workload import views
from workload.registry import query
from workload.sql_views import DETAIL_COLS, HIST_COLS, REPORT_COLS, actual_sql, report_sql

# --- joins ---------------------------------------------------------------------------------

_WINDOW_COLS = ("FOLIONUM", "CREATE_DATE", "ARRIVAL")


def _window_sql(strict: bool) -> str:
    days = "date_diff('day', d.CREATE_DATE, d.ARRIVAL)"
    if not strict:
        days = f"greatest(coalesce({days}, 0), 0)"
    top = "" if strict else " OR w.TO_DAY IS NULL"
    return (
        f"SELECT d.FOLIONUM, d.CREATE_DATE, d.ARRIVAL, w.ID AS WINDOW_ID FROM bk_base d "
        f"LEFT JOIN windows w ON {days} >= w.FROM_DAY AND ({days} <= w.TO_DAY{top})"
    )


@query("join_window_clamped", _window_sql(strict=False))
def join_window_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_lead_window(views.booking_base(spark, sf_dir, *_WINDOW_COLS))


@query("join_window_clamped_range", _window_sql(strict=False))
def join_window_clamped_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_lead_window(views.booking_base(spark, sf_dir, *_WINDOW_COLS), impl="range")


@query("join_window_clamped_lookup", _window_sql(strict=False))
def join_window_clamped_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_lead_window(views.booking_base(spark, sf_dir, *_WINDOW_COLS), impl="lookup")


@query("join_window_strict", _window_sql(strict=True))
def join_window_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_lead_window(views.booking_base(spark, sf_dir, *_WINDOW_COLS), mode=STRICT)


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staging as it is and detail as it was, as far as change detection looks at them."""
    rows = views.booking_base(spark, sf_dir, "PROPERTY", "REPORT_DATE", "STAYING", "MODIFIED_AT")
    return rows, views.detail_old(filters.otb(rows))


@query("join_changed_keys", "SELECT PROPERTY, REPORT_DATE, MODIFIED_AT FROM changed")
def join_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changed_keys(*_versions(spark, sf_dir))


@query(
    "join_restrict_to_keys",
    f"""SELECT {', '.join('d.' + c.strip() for c in DETAIL_COLS.split(','))} FROM canon d
        JOIN changed k ON d.PROPERTY = k.PROPERTY AND d.REPORT_DATE = k.REPORT_DATE""",
)
def join_restrict_to_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = changes.changed_keys(*_versions(spark, sf_dir))
    return changes.restrict_to_keys(views.canon(spark, sf_dir), keys)


_GAP_DAYS_SQL = """
    SELECT PROPERTY, REPORT_DATE FROM canon WHERE REPORT_DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-08'
    EXCEPT SELECT PROPERTY, STAYING + 1 FROM hist
"""


def _nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.booking_base(spark, sf_dir, "PROPERTY", "REPORT_DATE", "STAYING")


@query("join_gap_history", _GAP_DAYS_SQL)
def join_gap_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nights(spark, sf_dir)
    return changes.history_gaps(filters.reported_between(rows, *views.RESTORE), views.hist(rows))


@query(
    "join_gap_actual",
    "SELECT PROPERTY, STAYING FROM hist EXCEPT SELECT PROPERTY, STAYING_DATE FROM actual_old",
)
def join_gap_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = views.hist(views.canon(spark, sf_dir))
    return changes.actual_gaps(history, views.actual_old(history))


@query(
    "join_new_days",
    """SELECT PROPERTY, REPORT_DATE, STAYING FROM bk_base b
       WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.PROPERTY = b.PROPERTY AND h.STAYING = b.STAYING)""",
)
def join_new_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nights(spark, sf_dir)
    return changes.new_days(rows, views.hist(rows))


@query(
    "join_delete_keys",
    f"""SELECT {DETAIL_COLS} FROM detail_old t
        WHERE NOT EXISTS (SELECT 1 FROM changed k WHERE k.PROPERTY = t.PROPERTY AND k.REPORT_DATE = t.REPORT_DATE)""",
)
def join_delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = changes.changed_keys(*_versions(spark, sf_dir))
    return changes.delete_keys(views.detail_old(views.detail(spark, sf_dir)), keys)


@query(
    "join_date_shift",
    f"""SELECT {', '.join('d.' + c.strip() for c in HIST_COLS.split(','))} FROM canon d
        JOIN changed k ON d.PROPERTY = k.PROPERTY AND d.STAYING = k.REPORT_DATE - 1""",
)
def join_date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    nights = changes.shifted_nights(changes.changed_keys(*_versions(spark, sf_dir)))
    rows = changes.restrict_to_keys(views.canon(spark, sf_dir), nights, changes.NIGHT_KEY)
    return rows.drop("REPORT_DATE")


@query(
    "join_left_suffix",
    """WITH named AS (SELECT DISTINCT PROPERTY, NAME, FILE_ID FROM files),
            newest AS (SELECT PROPERTY, NAME, FILE_ID, FILE_ID % 2 = 0 AS ETL_CHECK FROM named WHERE FILE_ID % 3 = 0)
       SELECT f.PROPERTY, f.NAME, f.FILE_ID, r.FILE_ID AS FILE_ID_right, r.ETL_CHECK AS ETL_CHECK_right,
              CASE WHEN r.ETL_CHECK THEN TRUE ELSE FALSE END AS ETL_CHECK
       FROM named f LEFT JOIN newest r ON f.PROPERTY = r.PROPERTY AND f.NAME = r.NAME""",
)
def join_left_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded files' flag carried back to the whole listing."""
    files = views.files(spark, sf_dir).select("PROPERTY", "NAME", "FILE_ID").distinct()
    loaded = files.filter(F.col("FILE_ID") % 3 == 0).withColumn("ETL_CHECK", F.col("FILE_ID") % 2 == 0)
    return snapshots.carry_flag(files.withColumn("ETL_CHECK", F.lit(False)), loaded)


# --- aggregates ----------------------------------------------------------------------------


@query("agg_pace_report", report_sql("detail"))
def agg_pace_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pace_report(views.detail(spark, sf_dir))


@query("agg_pace_report_strict", report_sql("detail", strict=True))
def agg_pace_report_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pace_report(views.detail(spark, sf_dir), mode=STRICT)


@query("agg_pace_actual", actual_sql("(SELECT * FROM canon WHERE STAYING = REPORT_DATE - 1)"))
def agg_pace_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pace_actual(filters.past_night(views.canon(spark, sf_dir)))


@query("agg_pace_actual_strict", actual_sql("(SELECT * FROM canon WHERE STAYING = REPORT_DATE - 1)", strict=True))
def agg_pace_actual_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pace_actual(filters.past_night(views.canon(spark, sf_dir)), mode=STRICT)


@query(
    "agg_total_booking",
    """SELECT PROPERTY, CAST(SUM(CASE WHEN STAYING = ARRIVAL THEN N_OF_ROOM ELSE 0 END) AS INTEGER) AS TOTAL_BOOKING
       FROM bk_base GROUP BY PROPERTY""",
)
def agg_total_booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.booking_base(spark, sf_dir, "PROPERTY", "STAYING", "ARRIVAL", "N_OF_ROOM")
    return (
        rows.withColumn("BOOKING", booking_flag())
        .groupBy("PROPERTY")
        .agg(marts.total_booking().alias("TOTAL_BOOKING"))
    )


@query(
    "agg_latest_modified",
    "SELECT PROPERTY, REPORT_DATE, MAX(MODIFIED_AT) AS MODIFIED_AT FROM bk_base GROUP BY PROPERTY, REPORT_DATE",
)
def agg_latest_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_modified(_versions(spark, sf_dir)[0])


@query(
    "agg_property_watermark",
    """SELECT DISTINCT s.PROPERTY, s.REPORT_DATE, s.MODIFIED_AT FROM bk_base s
       LEFT JOIN (SELECT PROPERTY, MAX(MODIFIED_AT) AS WATERMARK FROM detail_old
                  WHERE PROPERTY <> 'Supplier#000000003' GROUP BY PROPERTY) w ON s.PROPERTY = w.PROPERTY
       WHERE s.MODIFIED_AT > coalesce(w.WATERMARK, TIMESTAMP '1900-01-01')""",
)
def agg_property_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _versions(spark, sf_dir)
    return changes.changed_since_watermark(source, target.filter(F.col("PROPERTY") != views.ABSENT_PROPERTY))


@query("agg_distinct_keys", "SELECT DISTINCT PROPERTY, REPORT_DATE, MODIFIED_AT FROM bk_base")
def agg_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.distinct_keys(_versions(spark, sf_dir)[0], ("PROPERTY", "REPORT_DATE", "MODIFIED_AT"))


_NEWEST_SQL = """
    SELECT PROPERTY, FILE_ID, NAME, MODIFIED_AT, CREATED_AT, REPORT_AT, REPORT_DATE FROM (
        SELECT *, row_number() OVER (PARTITION BY PROPERTY, REPORT_DATE
                                     ORDER BY REPORT_AT DESC, MODIFIED_AT DESC, NAME DESC) AS rn
        FROM (SELECT *, date_trunc('minute', MODIFIED_AT) AS REPORT_AT, CAST(MODIFIED_AT AS DATE) AS REPORT_DATE FROM files))
    WHERE rn = 1
"""


@query("agg_latest_snapshot", _NEWEST_SQL)
def agg_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.latest_per_day(snapshots.with_smile_name(views.files(spark, sf_dir)))


@query(
    "agg_count_by_day",
    "SELECT PROPERTY, REPORT_DATE, COUNT(*) AS NB_ROWS FROM detail GROUP BY PROPERTY, REPORT_DATE",
)
def agg_count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.count_by(filters.otb(_nights(spark, sf_dir)), "PROPERTY", "REPORT_DATE")


@query(
    "agg_count_by_day_stay",
    "SELECT PROPERTY, REPORT_DATE, STAYING, COUNT(*) AS NB_ROWS FROM detail GROUP BY PROPERTY, REPORT_DATE, STAYING",
)
def agg_count_by_day_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.count_by(filters.otb(_nights(spark, sf_dir)), "PROPERTY", "REPORT_DATE", "STAYING")


@query(
    "agg_coverage",
    """SELECT PROPERTY, MIN(REPORT_DATE) AS MIN_DATE, MAX(REPORT_DATE) AS MAX_DATE, COUNT(*) AS NB_ROWS
       FROM detail GROUP BY PROPERTY ORDER BY PROPERTY""",
)
def agg_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.coverage(filters.otb(_nights(spark, sf_dir)), "REPORT_DATE")


@query(
    "agg_freshness",
    """SELECT PROPERTY, STAYING, MAX(MODIFIED_AT) AS MODIFIED_AT FROM hist GROUP BY PROPERTY, STAYING
       ORDER BY PROPERTY, STAYING DESC""",
)
def agg_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.freshness(views.hist(_versions(spark, sf_dir)[0]), "STAYING")


# --- orders and limits ---------------------------------------------------------------------


@query(
    "ord_report",
    f"SELECT {REPORT_COLS} FROM ({report_sql('detail')}) "
    "ORDER BY REPORT_DATE, STAYING_DATE, PROPERTY, MARKET, R_TYPE, R_CHARGE, WINDOW_ID",
)
def ord_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ordered_report(agg_pace_report(spark, sf_dir))


@query(
    "ord_audit_desc",
    """SELECT PROPERTY, REPORT_DATE, COUNT(*) AS NB_ROWS FROM detail GROUP BY PROPERTY, REPORT_DATE
       ORDER BY REPORT_DATE DESC, PROPERTY""",
)
def ord_audit_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.count_by_day(filters.otb(_nights(spark, sf_dir)), "REPORT_DATE")


@query("ord_files", f"SELECT * FROM ({_NEWEST_SQL}) ORDER BY REPORT_DATE, PROPERTY, NAME")
def ord_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.ordered_files(agg_latest_snapshot(spark, sf_dir))


_REPORT_ORDER = ("REPORT_DATE", "STAYING_DATE", "PROPERTY", "MARKET", "R_TYPE", "R_CHARGE", "WINDOW_ID")


@query("lim_top", f"SELECT {REPORT_COLS} FROM ({report_sql('detail')}) ORDER BY {', '.join(_REPORT_ORDER)} LIMIT 100")
def lim_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.top(agg_pace_report(spark, sf_dir), 100, *_REPORT_ORDER)


@query(
    "lim_offset_fetch",
    f"SELECT {REPORT_COLS} FROM ({report_sql('detail')}) ORDER BY {', '.join(_REPORT_ORDER)} LIMIT 20 OFFSET 3000",
)
def lim_offset_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.page(agg_pace_report(spark, sf_dir), 3000, 20, *_REPORT_ORDER)


# --- set operations ------------------------------------------------------------------------


@query("set_union_properties", f"SELECT {DETAIL_COLS} FROM canon_both")
def set_union_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.union_layouts(*views.staging(spark, sf_dir))


@query(
    "set_concat_files",
    """SELECT 'a' || CAST(o_orderkey % 3 AS VARCHAR) AS SRC, CAST(o_orderkey AS INTEGER) AS FOLIO, CAST(o_orderdate AS DATE) AS DAY,
           o_orderstatus AS KIND FROM orders
       UNION ALL SELECT 'b' || CAST(event_id % 2 AS VARCHAR), CAST(event_id AS INTEGER), CAST(ts AS DATE), event_type FROM events""",
)
def set_concat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files of two column orders, one with a column nobody asked for, read as one frame by header."""
    root = scratch_path(spark, "concat")

    def part(letter: str, n: int) -> Column:
        return F.concat(F.lit(letter), (F.col("FOLIO") % n).cast("string")).alias("FOLDER")

    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("FOLIO"), F.to_date("o_orderdate").alias("DAY"), F.col("o_orderstatus").alias("KIND")
    )
    events = views.table(spark, sf_dir, "events").select(
        F.lit("x").alias("OTHER"), F.col("event_type").alias("KIND"), F.to_date("ts").alias("DAY"), F.col("event_id").alias("FOLIO")
    )
    for rows, letter, n in ((orders, "a", 3), (events, "b", 2)):
        rows.select("*", part(letter, n)).write.mode("append").partitionBy("FOLDER").csv(root, header=True, sep="\t")
    layout = Layout("", {}, {"FOLIO": "int", "DAY": "date", "KIND": "string"}, sep="\t")
    files = list_files(spark, root).filter(F.col("PATH").endswith(".csv"))
    return from_delimited(files, layout).rows.join(files.select("URI", F.col("FOLDER").alias("SRC")), "URI").drop("URI", "BAD_CELLS")


@query(
    "set_new_files",
    """SELECT PROPERTY, FILE_ID, NAME, MODIFIED_AT, CREATED_AT FROM files f
       WHERE NOT EXISTS (SELECT 1 FROM files a WHERE a.FILE_ID % 3 = 0 AND a.PROPERTY = f.PROPERTY AND a.NAME = f.NAME)""",
)
def set_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are not in the archive, which holds every third one."""
    files = views.files(spark, sf_dir)
    return snapshots.new_files(files, files.filter(F.col("FILE_ID") % 3 == 0))
