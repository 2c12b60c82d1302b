"""Run parameters and per-source column mappings.

Everything a layer needs is passed explicitly as a frozen ``LakeConfig``;
there are no module-level globals that jobs read behind the caller's back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """Where a raw source keeps the columns the canonical trip schema needs.

    ``amount``/``passengers`` are ``None`` for sources that cannot reach the
    silver layer (they stop at bronze).
    """

    name: str
    pickup: str
    dropoff: str
    amount: str | None = None
    passengers: str | None = None
    vendor: str | None = None

    @property
    def reaches_silver(self) -> bool:
        return None not in (self.amount, self.passengers, self.vendor)


# Raw column names per source, as the trip-record publisher ships them.
YELLOW = SourceSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                    "total_amount", "passenger_count", "VendorID")
GREEN = SourceSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                   "total_amount", "passenger_count", "VendorID")
FHV = SourceSpec("fhv", "pickup_datetime", "dropoff_datetime")
FHVHV = SourceSpec("fhvhv", "pickup_datetime", "dropoff_datetime")

SOURCES: dict[str, SourceSpec] = {s.name: s for s in (YELLOW, GREEN, FHV, FHVHV)}

# Canonical silver/gold columns, in table order.
CANONICAL_COLUMNS = (
    "VendorID",
    "passenger_count",
    "total_amount",
    "pickup_datetime",
    "dropoff_datetime",
    "taxi_type",
    "_bronze_source_file",
)

# The checks of the layer quality report, in report order.
QUALITY_CHECKS = (
    "null_pickup_datetime",
    "null_dropoff_datetime",
    "null_total_amount",
    "negative_total_amount",
    "null_passenger_count",
    "zero_passenger_count",
)

# Name fragments that mark a monetary column.
MONETARY_KEYWORDS = ("amount", "fare", "charge", "fee", "tip", "toll", "surcharge")

# Month labels of the reports (Portuguese abbreviations).
MONTH_LABELS = {1: "Jan", 2: "Fev", 3: "Mar", 4: "Abr", 5: "Mai", 6: "Jun",
                7: "Jul", 8: "Ago", 9: "Set", 10: "Out", 11: "Nov", 12: "Dez"}

# Fixed value: lineage tag written into every bronze row.
SOURCE_SYSTEM = "nyc_tlc"

# Fixed value: raw file name template; one file (or file directory) per source and month.
RAW_FILE_TEMPLATE = "{source}_tripdata_{year}-{month:02d}.parquet"


@dataclass(frozen=True)
class LakeConfig:
    """Parameters of one lake.

    Defaults fit the driver fixture (FIXTURES.md): trips of 1996-01..05.
    Real trip records of 2023 use ``LakeConfig(years=(2023,),
    start=dt.datetime(2023, 1, 1), period_end=dt.datetime(2023, 6, 1),
    focus_month=dt.datetime(2023, 5, 1), outlier_threshold=500.0)``.
    """

    years: tuple[int, ...] = (1996,)
    months: tuple[int, ...] = (1, 2, 3, 4, 5)
    sources: tuple[str, ...] = ("yellow", "green", "fhv", "fhvhv")
    # gold keeps pickup >= start; ``end`` is an optional ceiling (none by default)
    start: dt.datetime = dt.datetime(1996, 1, 1)
    end: dt.datetime | None = None
    # analysis period [start, period_end) and the one-month window of query 2
    period_end: dt.datetime = dt.datetime(1996, 6, 1)
    focus_month: dt.datetime = dt.datetime(1996, 5, 1)
    outlier_threshold: float = 100000.0
    source_system: str = SOURCE_SYSTEM
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    month_labels: dict = field(default_factory=lambda: dict(MONTH_LABELS))
    # warn threshold of the quality report, in percent
    warn_pct: float = 5.0

    @property
    def trip_sources(self) -> tuple[SourceSpec, ...]:
        return tuple(SOURCES[s] for s in self.sources if SOURCES[s].reaches_silver)

    @property
    def focus_month_end(self) -> dt.datetime:
        m = self.focus_month
        return dt.datetime(m.year + (m.month == 12), m.month % 12 + 1, 1)

    def spec(self, source: str) -> SourceSpec:
        return SOURCES[source]

    def year_months(self) -> list[tuple[int, int]]:
        return [(y, m) for y in self.years for m in self.months]
