"""Small fixed dimensions: lead-time windows, site registry, property dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LeadWindow:
    """One lead-time bucket in days; ``upper`` None means open-ended."""

    id: int
    label: str
    lower: int
    upper: int | None


@dataclass(frozen=True)
class Site:
    """One source of snapshots: property code, display name, landing folder, file layout."""

    code: str
    name: str
    folder: str
    template: str


SMILE_HL = "SMILE HL"
SMILE_PQ = "SMILE PQ"
OPERA = "Opera"
SMILE_TEMPLATES = (SMILE_HL, SMILE_PQ)

# Lead-time windows (id, label, from, to).
LEAD_WINDOWS: tuple[LeadWindow, ...] = (
    LeadWindow(1, "0-3 DAYS", 0, 3),
    LeadWindow(2, "<1 WEEK", 4, 7),
    LeadWindow(3, "2 WEEKS", 8, 14),
    LeadWindow(4, "3 WEEKS", 15, 21),
    LeadWindow(5, "4 WEEKS", 22, 30),
    LeadWindow(6, "1-2 MONTHS", 31, 60),
    LeadWindow(7, "2-3 MONTHS", 61, 90),
    LeadWindow(8, "3-6 MONTHS", 91, 180),
    LeadWindow(9, "6-12 MONTHS", 181, 365),
    LeadWindow(10, ">12 MONTHS", 366, None),
)

# Superseded bucket scheme (upper bound in days, label, sort number);
# the last row takes everything else, including an unknown lead time.
LEGACY_BUCKETS: tuple[tuple[int | None, str, int], ...] = (
    (7, "1 WEEK", 1),
    (14, "2 WEEKS", 2),
    (21, "3 WEEKS", 3),
    (30, "4 WEEKS", 4),
    (60, "1-2 MONTHS", 5),
    (90, "2-3 MONTHS", 6),
    (180, "3-6 MONTHS", 7),
    (365, "6-12 MONTHS", 8),
    (None, "> 12 MONTHS", 9),
)

# The sites (id, code, name, location, type, operator, system, data form),
# in display order.  A site without a data form is known but not loaded.
_PROPERTIES: tuple[tuple, ...] = (
    (665, "HLP", "Ha Long Plaza Hotel", "Ha Long", "Hotel", None, "SMILE", "SMILE HL"),
    (945, "SRC", "Syrena Cruises", "Ha Long", "Cruise", None, "SMILE", "SMILE HL"),
    (206, "FSH", "Fraser Suites Hanoi", "Ha Noi", "Hotel", "Fraser Hospitality", None, None),
    (393, "PHPQ", "Park Hyatt Phu Quoc Residences", "Phu Quoc", "Hotel", "Hyatt", "Opera", "Opera"),
    (200, "ICHL", "InterContinental Ha Long Bay Resort", "Ha Long", "Hotel", "IHG", "Opera", "Opera"),
    (209, "ICPQ", "InterContinental Phu Quoc Long Beach Resort", "Phu Quoc", "Hotel", "IHG", "Opera", "Opera"),
    (635, "REPQ", "Regent Phu Quoc", "Phu Quoc", "Hotel", "IHG", "Opera", "Opera"),
    (526, "CPV", "Crowne Plaza Vientiane", "Vientiane", "Hotel", "IHG", "Opera", "Opera"),
    (595, "HIVT", "Holiday Inn & Suites Vientiane", "Vientiane", "Hotel", "IHG", "Opera", "Opera"),
    (289, "SCSRHL", "Sailing Club Signature Resort Ha Long Bay", "Ha Long", "Hotel", "Sailing Club", "SMILE", "SMILE HL"),
    (371, "SCSRPQ", "Sailing Club Signature Resort Phu Quoc", "Phu Quoc", "Hotel", "Sailing Club", "SMILE", "SMILE PQ"),
    (702, "SBHPQ", "Soul Boutique Hotel Phu Quoc", "Phu Quoc", "Hotel", "Sailing Club", "SMILE", "SMILE PQ"),
    (893, "CMH", "Citadines Marina Ha Long", "Ha Long", "Hotel", "The Ascott", None, None),
)

SITES: tuple[Site, ...] = tuple(Site(p[1], p[2], p[1], p[7] or "") for p in _PROPERTIES)


def check_windows(windows: tuple[LeadWindow, ...] = LEAD_WINDOWS) -> tuple[LeadWindow, ...]:
    """Return the windows ordered by lower bound; refuse overlaps and an open window in the middle."""
    ordered = tuple(sorted(windows, key=lambda w: w.lower))
    for before, after in zip(ordered, ordered[1:]):
        if before.upper is None or before.upper >= after.lower:
            raise ValueError(f"lead windows {before.id} and {after.id} overlap")
    return ordered


def window_dim(spark: SparkSession, windows: tuple[LeadWindow, ...] = LEAD_WINDOWS) -> DataFrame:
    """Lead-time dimension: ID, WINDOW, FROM, TO (the last TO is NULL)."""
    rows = [(w.id, w.label, w.lower, w.upper) for w in windows]
    return spark.createDataFrame(rows, "ID int, WINDOW string, `FROM` int, `TO` int")


def site_registry(
    spark: SparkSession, sites: tuple[Site, ...] = SITES, *templates: str
) -> DataFrame:
    """Sites as CODE, NAME, FOLDER, TEMPLATE; only the given templates when any are named."""
    rows = [(s.code, s.name, s.folder, s.template) for s in sites]
    df = spark.createDataFrame(rows, "CODE string, NAME string, FOLDER string, TEMPLATE string")
    return df.filter(F.col("TEMPLATE").isin(*templates)) if templates else df


def property_dim(spark: SparkSession, owner_operator: str | None = None) -> DataFrame:
    """Property dimension; ``owner_operator`` is the operator of the sites the owner runs."""
    rows = [
        (*p[:5], (p[5] or owner_operator), *p[6:], position)
        for position, p in enumerate(_PROPERTIES, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "ID int, CODE string, NAME string, LOCATION string, TYPE string, OPERATOR string, "
        "SYSTEM_USED string, DATA_FORM string, ORDER_INDEX int",
    )
