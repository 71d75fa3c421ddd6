"""Scalar column functions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------
PING_SECONDS = 10.0

TEMPERATURE_CRITICAL, TEMPERATURE_DEGRADED = 75.0, 60.0
VIBRATION_CRITICAL, VIBRATION_DEGRADED = 80.0, 50.0
PRESSURE_CRITICAL, PRESSURE_DEGRADED = 2.0, 3.0

FEATURE_RANGES = {
    "age": (18.0, 80.0),
    "income": (15000.0, 150000.0),
    "credit_score": (300.0, 850.0),
    "employment_years": (0.0, 45.0),
    "debt_ratio": (0.0, 1.0),
    "num_accounts": (1.0, 15.0),
}

MIN_ACCURACY = 0.95
MAX_LOSS = 0.1

VALID_QUALITY = 0.7
COB_HOUR = 17
EARTH_RADIUS_KM = 6371.0

FAILURE_TYPES = [
    "SLA_BREACH", "JOB_FAILED", "INFRA_FAILURE", "SFN_TIMEOUT", "SCHEDULE_MISSED",
    "VALIDATION_EXHAUSTED", "RETRY_EXHAUSTED", "JOB_POLL_EXHAUSTED", "DATA_DRIFT",
]
WARNING_TYPES = ["SLA_WARNING"]
SUCCESS_TYPES = ["SLA_MET", "JOB_COMPLETED", "VALIDATION_PASSED"]
SEVERITIES = ["critical", "warning", "success", "info"]
SLA_TYPES = ["SLA_MET", "SLA_WARNING", "SLA_BREACH"]
# -------------------------------------------------------------------------


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonym(phone: Column | str, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), col(phone)), 256)


_HOURS = [f"{h:02d}" for h in range(24)]


def par_day(ts: Column | str) -> Column:
    """``yyyyMMdd``. Arithmetic costs half of what a date formatter does per row."""
    t = col(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("string")


def par_hour(ts: Column | str) -> Column:
    """``HH``, zero padded."""
    return F.element_at(F.array(*[F.lit(h) for h in _HOURS]), F.hour(col(ts)) + 1)


def iso_seconds(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ntz(ts: Column | str) -> Column:
    return col(ts).cast("timestamp_ntz")


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def period_start(day: Column | str, hour: Column | str | None = None) -> Column:
    """``20240105`` and ``04`` (or no hour) to the timestamp the period begins at."""
    if hour is None:
        return F.to_timestamp_ntz(col(day), F.lit("yyyyMMdd"))
    return F.to_timestamp_ntz(F.concat(col(day), col(hour)), F.lit("yyyyMMddHH"))


def parse_period(period: Column | str) -> Column:
    """``20240105T04`` to a timestamp."""
    return F.to_timestamp_ntz(F.replace(col(period), F.lit("T"), F.lit("")), F.lit("yyyyMMddHH"))


def hour_of_millis(ms: Column | str) -> Column:
    return F.floor(F.pmod(col(ms), F.lit(86_400_000)) / 3_600_000).cast("int")


def time_of_millis(ms: Column | str) -> Column:
    return ntz(F.timestamp_millis(col(ms)))


def floor_window(ts: Column | str, seconds: int = 900) -> Column:
    """Start of the tumbling window a timestamp falls in. Unlike ``window`` it may
    stand several times in one select."""
    return time_of_micros(floor_micros(epoch_micros(ts), seconds))


def floor_micros(us: Column | str, seconds: int) -> Column:
    return col(us) - F.pmod(col(us), F.lit(seconds * 1_000_000))


def time_of_micros(us: Column | str) -> Column:
    return ntz(F.timestamp_micros(col(us)))


def machine_health(temperature, vibration, pressure) -> Column:
    t, v, p = col(temperature), col(vibration), col(pressure)
    critical = (t >= TEMPERATURE_CRITICAL) | (v >= VIBRATION_CRITICAL) | (p <= PRESSURE_CRITICAL)
    degraded = (t >= TEMPERATURE_DEGRADED) | (v >= VIBRATION_DEGRADED) | (p <= PRESSURE_DEGRADED)
    return F.when(critical, "critical").when(degraded, "degraded").otherwise("healthy")


def min_max(name: str) -> Column:
    """Fixed-range scaling to six places; values outside the range are not clipped."""
    low, high = FEATURE_RANGES[name]
    return F.round((F.col(name).cast("double") - low) / (high - low), 6).alias(name)


def credit_label(credit_score, income, debt_ratio, employment_years) -> Column:
    score = (
        F.lit(0.4) * (col(credit_score) - 300) / 550
        + F.lit(0.3) * F.least(col(income) / 100000, F.lit(1.0))
        + F.lit(0.2) * (1 - col(debt_ratio))
        + F.lit(0.1) * F.least(col(employment_years) / 20, F.lit(1.0))
    )
    return F.when(score >= 0.5, 1).otherwise(0)


def is_nan_text(value: Column | str) -> Column:
    """True for the text ``nan`` in any case. Test this before any comparison:
    Spark orders NaN above every number."""
    return F.lower(F.trim(col(value).cast("string"))) == "nan"


def severity(event_type: Column | str) -> Column:
    e = col(event_type)
    return (
        F.when(e.isin(FAILURE_TYPES), "critical")
        .when(e.isin(WARNING_TYPES), "warning")
        .when(e.isin(SUCCESS_TYPES), "success")
        .otherwise("info")
    )


def severity_rank(event_type: Column | str) -> Column:
    """0 is the worst."""
    e = col(event_type)
    return F.when(e.isin(FAILURE_TYPES), 0).when(e.isin(WARNING_TYPES), 1).when(e.isin(SUCCESS_TYPES), 2).otherwise(3)


def severity_of_rank(rank: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), (col(rank) + 1).cast("int"))


def traffic_weight(hour: Column | str) -> Column:
    """Two daily peaks, at 10h and 20h, over a floor of 0.10."""
    h = col(hour)
    return F.lit(0.10) + F.lit(0.70) * F.exp(-F.pow(h - 10, 2) / 18) + F.lit(0.50) * F.exp(-F.pow(h - 20, 2) / 12.5)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    half_lat = F.radians(col(lat2) - col(lat1)) / 2
    half_lon = F.radians(col(lon2) - col(lon1)) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def tower_id(lat, lon) -> Column:
    return F.substring(F.md5(F.concat_ws(",", col(lat).cast("string"), col(lon).cast("string"))), 1, 8)


def row_fingerprint(*cols: str) -> Column:
    """First eight hex digits of a row's md5 as a number, so that sums do not depend on order."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seconds_of(text: str) -> int:
    """``5m``, ``2h``, ``30s`` to seconds."""
    return int(text[:-1]) * {"s": 1, "m": 60, "h": 3600}[text[-1]]


def weight_total(windows: int = 96) -> float:
    """Sum of the traffic weight over the window midpoints of one day."""
    step = 24 / windows
    mids = ((i + 0.5) * step for i in range(windows))
    return math.fsum(
        0.10 + 0.70 * math.exp(-((m - 10) ** 2) / 18) + 0.50 * math.exp(-((m - 20) ** 2) / 12.5) for m in mids
    )
