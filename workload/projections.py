"""Queries over projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions import dates, fx, lead, money
from stayledger.operators import canonical, filters, snapshots
from stayledger.plans.rates import usd_rates
from stayledger.plans.staging import stamped
from stayledger.schemas import SMILE_HL_HEADERS, SMILE_PQ_HEADERS, required
from workload import views
from workload.mutations import RATES_SQL, landed_json
from workload.registry import query
from workload.sql_views import DETAIL_COLS, HIST_COLS

# --- projections ---------------------------------------------------------------------------


@query(
    "prj_rename_template",
    """SELECT FOLIONUM, ARRIVAL, DEPARTURE, STAYING, CREATE_DATE AS CREATE_TIME, MARKET, RATE_CODE, RATE_AMT, ARR, ROOM_REV,
              FB_REV, OTHER_REV, STATUS, R_TYPE, R_CHARGE, N_OF_ROOM, N_OF_ADT, N_OF_CHD, BK_SOURCE, COUNTRY, NATIONALITY
       FROM bk_base""",
)
def prj_rename_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File headers of the PQ layout to column names."""
    base = views.booking_base(spark, sf_dir).withColumnRenamed("CREATE_DATE", "CREATE_TIME")
    headed = base.select(*(F.col(c).alias(h) for h, c in SMILE_PQ_HEADERS.items() if c in base.columns))
    return canonical.rename_headers(headed, SMILE_PQ_HEADERS)


_REQUIRED = [c for c in SMILE_HL_HEADERS.values() if c not in ("CREATE_TIME", "GROUP_CODE", "GROUP_NAME", "TA", "TA_ID",
             "GUEST_NAME", "PACKAGE_CODE", "PACKAGE_AMOUNT", "R_SURCHARGE")]


@query("prj_required_columns", f"SELECT {', '.join(_REQUIRED)} FROM bk_base")
def prj_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return required(views.booking_base(spark, sf_dir), _REQUIRED)


@query(
    "prj_provenance",
    """SELECT CAST(e.ts AS DATE) AS REPORT_DATE, e.event_type AS PROPERTY, e.ts AS CREATED_AT, e.ts AS MODIFIED_AT,
              'Pace ' || e.event_type || ' Date' || strftime(e.ts, '%d%m%Y_%H%M') || '.xls' AS FILE_NAME,
              CAST(l.l_orderkey AS INTEGER) AS FOLIONUM, CAST(l.l_quantity AS INTEGER) AS N_OF_ROOM
       FROM lineitem l JOIN events e ON l.l_orderkey % (SELECT COUNT(*) FROM events) = e.event_id""",
)
def prj_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row dealt to a file and stamped with the file's property, day, times and name."""
    files = snapshots.with_smile_name(views.files(spark, sf_dir))
    rows = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % files.count()).cast("string").alias("URI"),
        F.col("l_orderkey").alias("FOLIONUM"),
        F.col("l_quantity").alias("N_OF_ROOM"),
    )
    named = files.withColumn("URI", F.col("FILE_ID").cast("string"))
    stamp = {"REPORT_DATE": "date", "PROPERTY": "string", "CREATED_AT": "timestamp_ntz", "MODIFIED_AT": "timestamp_ntz", "FILE_NAME": "string"}
    return stamped(rows, named, stamp | {"FOLIONUM": "int", "N_OF_ROOM": "int"})


@query("prj_canonical_smile", f"SELECT {DETAIL_COLS} FROM canon")
def prj_canonical_smile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.canon(spark, sf_dir)


@query("prj_canonical_opera", f"SELECT {DETAIL_COLS} FROM canon_opera")
def prj_canonical_opera(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical_opera(views.opera_rows(views.booking_base(spark, sf_dir)))


_HISTORY_SQL = f"""
    SELECT {HIST_COLS} FROM (
        SELECT * REPLACE (CAST(ARR + ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS TOTAL_TURN_OVER) FROM canon)
    JOIN layouts USING (PROPERTY) WHERE LAYOUT = 'SMILE'
    UNION ALL
    SELECT {HIST_COLS} FROM (
        SELECT * REPLACE (CAST(ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS TOTAL_TURN_OVER) FROM canon_opera)
    JOIN layouts USING (PROPERTY) WHERE LAYOUT = 'OPERA'
"""


@query("prj_canonical_history", _HISTORY_SQL)
def prj_canonical_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    smile, opera = views.staging(spark, sf_dir)
    return canonical.canonical_history_smile(smile).unionByName(canonical.canonical_history_opera(opera))


# --- filters -------------------------------------------------------------------------------


@query("flt_otb", f"SELECT {DETAIL_COLS} FROM detail")
def flt_otb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.detail(spark, sf_dir)


@query(
    "flt_actual_yesterday",
    f"SELECT {DETAIL_COLS} FROM canon WHERE REPORT_DATE = DATE '2024-01-06' AND STAYING = REPORT_DATE - 1",
)
def flt_actual_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.past_night(views.canon(spark, sf_dir), views.AS_OF)


@query("flt_actual_any_day", f"SELECT {DETAIL_COLS} FROM canon WHERE STAYING = REPORT_DATE - 1")
def flt_actual_any_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.past_night(views.canon(spark, sf_dir))


@query(
    "flt_property_cutoff",
    f"SELECT {DETAIL_COLS} FROM canon WHERE PROPERTY = '{views.LOADED_PROPERTY}' AND STAYING <= DATE '2024-01-05'",
)
def flt_property_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.up_to(views.canon(spark, sf_dir), views.LOADED_PROPERTY, views.CUTOFF)


@query(
    "flt_report_range",
    f"""SELECT 'day' AS KIND, {DETAIL_COLS} FROM canon
        WHERE REPORT_DATE >= DATE '2024-01-02' AND REPORT_DATE <= DATE '2024-01-08'
        UNION ALL
        SELECT 'night', {DETAIL_COLS} FROM canon
        WHERE STAYING + 1 >= DATE '2024-01-02' AND STAYING + 1 <= DATE '2024-01-08'""",
)
def flt_report_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = views.canon(spark, sf_dir)
    by_day = filters.reported_between(canon, *views.RESTORE).withColumn("KIND", F.lit("day"))
    by_night = filters.night_reported_between(canon, *views.RESTORE).withColumn("KIND", F.lit("night"))
    return by_day.unionByName(by_night)


@query(
    "flt_in_list",
    f"SELECT {DETAIL_COLS} FROM canon WHERE PROPERTY IN ('{views.LOADED_PROPERTY}', '{views.ABSENT_PROPERTY}')",
)
def flt_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.in_list(views.canon(spark, sf_dir), "PROPERTY", [views.LOADED_PROPERTY, views.ABSENT_PROPERTY])


@query("flt_null_audit", f"SELECT {DETAIL_COLS} FROM canon WHERE CREATE_DATE IS NULL OR STAYING IS NULL")
def flt_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.null_dates(views.canon(spark, sf_dir), "CREATE_DATE", "STAYING")


@query(
    "flt_same_day_files",
    """WITH named AS (SELECT *, date_trunc('minute', MODIFIED_AT) AS REPORT_AT, CAST(MODIFIED_AT AS DATE) AS REPORT_DATE FROM files)
       SELECT * FROM named f WHERE EXISTS (SELECT 1 FROM named p WHERE p.MODIFIED_AT >= TIMESTAMP '2024-01-15 12:00:00'
           AND p.PROPERTY = f.PROPERTY AND p.REPORT_DATE = f.REPORT_DATE)""",
)
def flt_same_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = snapshots.with_smile_name(views.files(spark, sf_dir))
    late = files.filter(F.col("MODIFIED_AT") >= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return filters.same_day_files(files, late)


# --- scalar expressions --------------------------------------------------------------------


@query(
    "fn_excel_serial",
    """SELECT l_orderkey, l_linenumber, 40000 + l_quantity + l_discount AS SERIAL,
              DATE '1899-12-30' + CAST(floor(40000 + l_quantity + l_discount) AS INTEGER) AS DAY FROM lineitem""",
)
def fn_excel_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.lit(40000) + F.col("l_quantity") + F.col("l_discount")
    rows = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", serial.alias("SERIAL"))
    return rows.withColumn("DAY", dates.excel_serial_date("SERIAL"))


def _order_days(spark: SparkSession, sf_dir: str, text) -> DataFrame:
    return views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("TEXT"))


_BROKEN = "CASE WHEN o_orderstatus = 'P' THEN '31-02-2024' ELSE {} END"


@query(
    "fn_date_coerce",
    f"""SELECT o_orderkey, {_BROKEN.format("strftime(o_orderdate, '%-d-%-m-%Y')")} AS TEXT,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS DAY FROM orders""",
)
def fn_date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "31-02-2024").otherwise(F.date_format("o_orderdate", "d-M-yyyy"))
    return _order_days(spark, sf_dir, text).withColumn("DAY", dates.coerce_date("TEXT"))


@query(
    "fn_date_abbrev",
    """SELECT o_orderkey, upper(strftime(o_orderdate, '%d/%b/%y')) AS TEXT, CAST(o_orderdate AS DATE) AS DAY FROM orders""",
)
def fn_date_abbrev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days span both sides of the two-digit century break."""
    text = F.upper(F.date_format("o_orderdate", "dd/MMM/yy"))
    return _order_days(spark, sf_dir, text).withColumn("DAY", dates.abbrev_date("TEXT"))


@query(
    "fn_date_dayfirst",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'soon' WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                 ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS TEXT,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS DAY FROM orders""",
)
def fn_date_dayfirst(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "P", "soon")
        .when(status == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return _order_days(spark, sf_dir, text).withColumn("DAY", dates.dayfirst_date("TEXT"))


@query("fn_to_date", "SELECT event_id, CAST(ts AS DATE) AS DAY FROM events")
def fn_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("DAY"))


@query("fn_stay_month", "SELECT event_id, strftime(ts, '%Y-%m') AS STAY_MONTH FROM events")
def fn_stay_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select("event_id", dates.stay_month(F.to_date("ts")).alias("STAY_MONTH"))


_LEAD = "date_diff('day', CREATE_DATE, ARRIVAL)"


def _lead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.booking_base(spark, sf_dir, "FOLIONUM", "CREATE_DATE", "ARRIVAL")


@query("fn_lead_days", f"SELECT FOLIONUM, CREATE_DATE, ARRIVAL, CAST({_LEAD} AS INTEGER) AS DAYS FROM bk_base")
def fn_lead_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead_rows(spark, sf_dir).withColumn("DAYS", dates.lead_days())


@query(
    "fn_lead_days_clamped",
    f"""SELECT FOLIONUM, CREATE_DATE, ARRIVAL,
               CAST(CASE WHEN {_LEAD} > 0 THEN {_LEAD} ELSE 0 END AS INTEGER) AS DAYS FROM bk_base""",
)
def fn_lead_days_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead_rows(spark, sf_dir).withColumn("DAYS", dates.lead_days_clamped())


# Upper bounds and labels of the superseded lead buckets.
_LEGACY = [(7, "1 WEEK"), (14, "2 WEEKS"), (21, "3 WEEKS"), (30, "4 WEEKS"), (60, "1-2 MONTHS"), (90, "2-3 MONTHS"),
           (180, "3-6 MONTHS"), (365, "6-12 MONTHS")]
LEGACY_LABEL = "CASE " + " ".join(f"WHEN {_LEAD} <= {n} THEN '{label}'" for n, label in _LEGACY) + " ELSE '> 12 MONTHS' END"
LEGACY_SORT = "CASE " + " ".join(f"WHEN {_LEAD} <= {n} THEN {i}" for i, (n, _) in enumerate(_LEGACY, 1)) + " ELSE 9 END"


@query(
    "fn_lead_bucket_case",
    f"""SELECT FOLIONUM, CREATE_DATE, ARRIVAL, {LEGACY_LABEL} AS "WINDOW", CAST({LEGACY_SORT} AS INTEGER) AS WINDOW_SORT
        FROM bk_base""",
)
def fn_lead_bucket_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dates.lead_days()
    return _lead_rows(spark, sf_dir).withColumns(
        {"WINDOW": lead.legacy_bucket(days), "WINDOW_SORT": lead.legacy_bucket_sort(days)}
    )


@query("fn_date_shift", "SELECT event_id, CAST(ts AS DATE) - 1 AS BEFORE, CAST(ts AS DATE) + 7 AS AFTER FROM events")
def fn_date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    return views.table(spark, sf_dir, "events").select(
        "event_id", dates.shift_date(day, -1).alias("BEFORE"), dates.shift_date(day, 7).alias("AFTER")
    )


_TERMS = ("FOLIONUM", "ARR", "ROOM_REV", "FB_REV", "OTHER_REV")


@query(
    "fn_turnover_null_safe",
    """SELECT FOLIONUM, ARR, ROOM_REV, FB_REV, OTHER_REV,
              CAST(coalesce(ARR,0) + coalesce(ROOM_REV,0) + coalesce(FB_REV,0) + coalesce(OTHER_REV,0) AS DECIMAL(18,2)) AS FOUR_TERMS,
              CAST(coalesce(ROOM_REV,0) + coalesce(FB_REV,0) + coalesce(OTHER_REV,0) AS DECIMAL(18,2)) AS THREE_TERMS
       FROM bk_base""",
)
def fn_turnover_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.booking_base(spark, sf_dir, *_TERMS).withColumns(
        {
            "FOUR_TERMS": money.turnover_null_safe("ARR", "ROOM_REV", "FB_REV", "OTHER_REV"),
            "THREE_TERMS": money.turnover_null_safe("ROOM_REV", "FB_REV", "OTHER_REV"),
        }
    )


@query(
    "fn_turnover_null_prop",
    """SELECT FOLIONUM, ARR, ROOM_REV, FB_REV, OTHER_REV,
              CAST(ARR + ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS FOUR_TERMS,
              CAST(ROOM_REV + FB_REV + OTHER_REV AS DECIMAL(18,2)) AS THREE_TERMS
       FROM bk_base""",
)
def fn_turnover_null_prop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.booking_base(spark, sf_dir, *_TERMS).withColumns(
        {
            "FOUR_TERMS": money.turnover_null_prop("ARR", "ROOM_REV", "FB_REV", "OTHER_REV"),
            "THREE_TERMS": money.turnover_null_prop("ROOM_REV", "FB_REV", "OTHER_REV"),
        }
    )


@query(
    "fn_booking_flag",
    "SELECT FOLIONUM, STAYING, ARRIVAL, CASE WHEN STAYING = ARRIVAL THEN 1 ELSE 0 END AS BOOKING FROM bk_base",
)
def fn_booking_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.booking_base(spark, sf_dir, "FOLIONUM", "STAYING", "ARRIVAL")
    return rows.withColumn("BOOKING", money.booking_flag())


@query(
    "fn_booking_flag_legacy",
    "SELECT FOLIONUM, CREATE_DATE, ARRIVAL, CASE WHEN CREATE_DATE = ARRIVAL THEN 1 ELSE 0 END AS BOOKING FROM bk_base",
)
def fn_booking_flag_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead_rows(spark, sf_dir).withColumn("BOOKING", money.booking_flag_legacy())


def _texts(spark: SparkSession, sf_dir: str, text) -> DataFrame:
    return views.table(spark, sf_dir, "events").select("event_id", text.alias("TEXT"))


@query(
    "fn_fx_split_pair",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'none' ELSE event_type || '/' || user_id END AS TEXT,
              CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS FROM_CURRENCY_CODE,
              CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS TO_CURRENCY_CODE FROM events""",
)
def fn_fx_split_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"))
    text = F.when(F.col("event_type") == "error", "none").otherwise(pair)
    return _texts(spark, sf_dir, text).withColumns(
        {"FROM_CURRENCY_CODE": fx.pair_part("TEXT", 1), "TO_CURRENCY_CODE": fx.pair_part("TEXT", 2)}
    )


@query(
    "fn_fx_first_token",
    "SELECT event_id, event_type || ' x ' || user_id AS TEXT, event_type AS TOKEN FROM events",
)
def fn_fx_first_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("event_type", F.lit(" x "), F.col("user_id").cast("string"))
    return _texts(spark, sf_dir, text).withColumn("TOKEN", fx.first_token("TEXT"))


@query(
    "fn_fx_number",
    """SELECT event_id, TEXT, TRY_CAST(CASE WHEN starts_with(digits, '0') THEN '0.' || digits[2:] ELSE digits END AS DOUBLE) AS RATE
       FROM (SELECT event_id, TEXT, replace(TEXT, '.', '') AS digits FROM (
           SELECT event_id, CASE event_type WHEN 'error' THEN '-' WHEN 'click' THEN '0.' || user_id
                  ELSE user_id || '.650' END AS TEXT FROM events))""",
)
def fn_fx_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    text = (
        F.when(F.col("event_type") == "error", "-")
        .when(F.col("event_type") == "click", F.concat(F.lit("0."), user))
        .otherwise(F.concat(user, F.lit(".650")))
    )
    return _texts(spark, sf_dir, text).withColumn("RATE", fx.rate_number("TEXT"))


@query("fn_fx_usd_shape", f"WITH {RATES_SQL} SELECT * FROM fresh")
def fn_fx_usd_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usd_rates(landed_json(spark, sf_dir))
