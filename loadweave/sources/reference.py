"""Small reference tables and constants of the data model.

The values in this module are fixed values: results only come out right with exactly these.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Code, number, unit, direction, flow, aggregation rule, description, active.
CHANNELS = [
    ("KWH_DEL", 1, "KWH", "DELIVERED", "REAL", "SUM", "Real energy delivered to premise", True),
    ("KWH_REC", 2, "KWH", "RECEIVED", "REAL", "SUM", "Real energy exported by premise (DER)", True),
    ("KW_DEM", 5, "KW", "DELIVERED", "REAL", "MAX", "Peak real power demand in interval", True),
    ("KVARH_D", 7, "KVARH", "DELIVERED", "REACTIVE", "SUM", "Reactive energy delivered", False),
    ("KVARH_R", 8, "KVARH", "RECEIVED", "REACTIVE", "SUM", "Reactive energy received", False),
    ("KVAR_DEM", 9, "KVAR", "DELIVERED", "REACTIVE", "MAX", "Peak reactive demand in interval", False),
    ("VOLT_AVG", 21, "V", "NONE", "VOLTAGE", "AVG", "Average voltage in interval", True),
    ("VOLT_MIN", 22, "V", "NONE", "VOLTAGE", "MIN", "Min voltage in interval", False),
    ("VOLT_MAX", 23, "V", "NONE", "VOLTAGE", "MAX", "Max voltage in interval", False),
    ("AMPS", 31, "A", "NONE", "CURRENT", "AVG", "Average current in interval", False),
    ("PF", 40, "RATIO", "NONE", "APPARENT", "AVG", "Power factor", False),
]

# Territories and the zone each keeps.
TERRITORY_ZONES = {
    "NE": "America/New_York",
    "SE": "America/New_York",
    "MW": "America/Chicago",
    "W": "America/Los_Angeles",
}
TERRITORIES = ["NE", "SE", "MW", "W"]

# Premise type to customer segment.
SEGMENTS = {"RES": "RESIDENTIAL", "SMB": "SMALL_BUSINESS", "CNI": "COMMERCIAL"}

# Months of the two named seasons; all others are SHOULDER.
SUMMER_MONTHS = [6, 7, 8, 9]
WINTER_MONTHS = [12, 1, 2]

# Holidays of the sample calendar.
HOLIDAYS = ["2024-01-01", "2024-01-15"]

# Plan, day type, first and last minute of day (inclusive), bucket, $/kWh, $/kW.
RATE_BANDS = [
    ("RP-FLAT", "WEEKDAY", 0, 1439, "OFF_PEAK", "0.12000", "0.0000"),
    ("RP-FLAT", "WEEKEND", 0, 1439, "OFF_PEAK", "0.12000", "0.0000"),
    ("RP-FLAT", "HOLIDAY", 0, 1439, "OFF_PEAK", "0.12000", "0.0000"),
    ("RP-TOU3", "WEEKDAY", 0, 419, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-TOU3", "WEEKDAY", 420, 959, "SHOULDER", "0.14000", "4.0000"),
    ("RP-TOU3", "WEEKDAY", 960, 1259, "ON_PEAK", "0.28000", "8.0000"),
    ("RP-TOU3", "WEEKDAY", 1260, 1439, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-TOU3", "WEEKEND", 0, 1439, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-TOU3", "HOLIDAY", 0, 1439, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-CPP", "WEEKDAY", 0, 419, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-CPP", "WEEKDAY", 420, 959, "SHOULDER", "0.14000", "4.0000"),
    ("RP-CPP", "WEEKDAY", 960, 1259, "CRITICAL", "0.45000", "12.0000"),
    ("RP-CPP", "WEEKDAY", 1260, 1439, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-CPP", "WEEKEND", 0, 1439, "OFF_PEAK", "0.08000", "0.0000"),
    ("RP-CPP", "HOLIDAY", 0, 1439, "OFF_PEAK", "0.08000", "0.0000"),
]

# Role to territory. Deployments pass their own map.
ROLE_TERRITORIES = [
    ("ANALYST_NE", "NE"),
    ("ANALYST_SE", "SE"),
    ("ANALYST_MW", "MW"),
    ("ANALYST_W", "W"),
]
SEE_ALL_ROLES = ["ADMIN", "SYSADMIN", "OWNER", "ENG", "OPS"]
UNMASKED_ROLES = ["ADMIN", "OWNER", "ENG"]

# Texts that results carry.
DUPLICATE_RESOLUTION = "last-write-wins (kept VALUE_SECOND)"
SLA_BREACH_MESSAGE = "SLA breach: ingestion < {}% within 15-min window"

# Report constants.
FLAT_RATE_PER_KWH = Decimal("0.15")
KWH_PER_HELD_BILL = 750
KWH_PER_LATE_READ = 2.0
ON_TIME_LIMIT_SEC = 900
VERY_LATE_LIMIT_SEC = 3600
SLA_THRESHOLD_PCT = 95
READY_COMPLETENESS_PCT = 99
READY_VEE_PCT = 97


def inline(spark: SparkSession, rows: list[tuple], ddl: list[tuple[str, str]]) -> DataFrame:
    """A literal table. VALUES keeps it a local relation with an exact size, so the planner can
    see that it may be broadcast; a Python-built frame would have no usable statistics."""

    def literal(value: object, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        text = str(value).replace("'", "\\'")
        return f"CAST('{text}' AS {kind})"

    body = ", ".join(
        "(" + ", ".join(literal(v, kind) for v, (_, kind) in zip(row, ddl)) + ")" for row in rows
    )
    names = ", ".join(name for name, _ in ddl)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def channel_catalog(spark: SparkSession) -> DataFrame:
    return inline(spark, CHANNELS, [
        ("channel_code", "string"), ("channel_number", "int"), ("uom", "string"),
        ("direction", "string"), ("flow_type", "string"), ("aggregation", "string"),
        ("description", "string"), ("is_active", "boolean"),
    ])


def rate_windows(spark: SparkSession) -> DataFrame:
    """Time-of-use windows; minutes of day, both ends inclusive, non-overlapping."""
    rows = [
        (f"{plan}-{day}-{first}", plan, day, "ALL", first, last, bucket, energy, demand)
        for plan, day, first, last, bucket, energy, demand in RATE_BANDS
    ]
    return inline(spark, rows, [
        ("rate_window_id", "string"), ("rate_plan_id", "string"), ("day_type", "string"),
        ("season", "string"), ("start_minute", "int"), ("end_minute", "int"),
        ("tou_bucket", "string"), ("energy_rate_per_kwh", "decimal(8,5)"),
        ("demand_rate_per_kw", "decimal(8,4)"),
    ])


def holidays(spark: SparkSession, dates: list[str] = HOLIDAYS) -> DataFrame:
    return inline(spark, [(d,) for d in dates], [("holiday_date", "date")])


def role_territories(spark: SparkSession, pairs: list[tuple] = ROLE_TERRITORIES) -> DataFrame:
    return inline(spark, pairs, [("role_name", "string"), ("utility_territory", "string")])
