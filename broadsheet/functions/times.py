"""Timestamp text rules. Timestamps are ISO text, ``yyyy-MM-dd`` with an optional time; the session zone must be UTC."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import strip

# Texts that stand for "no timestamp".
PLACEHOLDERS = ("0000-00-00 00:00:00", "0000-00-00")
MISSING_TOKENS = ("", "NA", "N/A", "null", "None", "0000-00-00 00:00:00", "0000-00-00")
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}(?!\d)"

# Calendar parts with their value where no valid timestamp was seen, and the 12 time features in order.
PARTS = {"year": 1970, "month": 1, "dow": 0, "hour": 0, "doy": 1}
TIME_FEATURES = (
    "year", "month", "doy", "dow", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "month_sin", "month_cos", "doy_sin", "doy_cos",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Feature variant: stripped, seven missing tokens, UTC."""
    s = strip(_col(c))
    return F.when(~s.isin(*MISSING_TOKENS) & s.rlike(ISO_DATE), s.try_cast("timestamp"))


def eda_timestamp(c: Column | str) -> Column:
    """Profiling variant: two placeholders, not stripped, no zone."""
    s = _col(c)
    return F.when(~s.isin(*PLACEHOLDERS) & s.rlike(ISO_DATE), s.try_cast("timestamp_ntz"))


def timestamp_missing(c: Column | str) -> Column:
    return parse_timestamp(c).isNull().cast("double")


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts), "month": F.month(ts), "dow": F.weekday(ts), "hour": F.hour(ts), "doy": F.dayofyear(ts),
    }


def time_features(parts: dict[str, Column]) -> list[Column]:
    """The 12 time features from complete calendar parts."""
    def angle(part: Column, period: float) -> Column:
        return F.lit(2.0 * math.pi) * part / F.lit(period)

    turns = {
        "hour": angle(parts["hour"], 24.0), "dow": angle(parts["dow"], 7.0),
        "month": angle(parts["month"] - 1, 12.0), "doy": angle(parts["doy"] - 1, 365.0),
    }
    out = {name: parts[name].cast("double") for name in ("year", "month", "doy", "dow")}
    for name, turn in turns.items():
        out[f"{name}_sin"] = F.sin(turn)
        out[f"{name}_cos"] = F.cos(turn)
    return [out[name].alias(name) for name in TIME_FEATURES]
