"""Text labels and flags derived from class, hour and amount."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report labels.
CLASS_LABELS = ("Fraud", "Legitimate")
QUERY_BANDS = ("High-Risk (Late Night)", "Medium-Risk", "Low-Risk (Business Hours)")
DASHBOARD_BANDS = (
    "High-Risk (Late Night)",
    "Medium-Risk (Transitional)",
    "Low-Risk (Business Hours)",
)
BLOCK_NAMES = ("Night", "Morning", "Afternoon", "Evening")
RISK_LEVELS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
AUDIT_LABELS = ("✓ FRAUD", "Suspected")

# Hour sets behind the bands.
LATE_NIGHT_START, LATE_NIGHT_END = 23, 4
MEDIUM_HOURS = ((5, 8), (20, 22))


def class_label(label: Column, names: tuple[str, str] = CLASS_LABELS) -> Column:
    return F.when(label == 1, names[0]).otherwise(names[1])


def is_late_night(hour: Column, start: int = LATE_NIGHT_START, end: int = LATE_NIGHT_END) -> Column:
    """The window that wraps midnight: hour >= start or hour <= end."""
    return (hour >= start) | (hour <= end)


def risk_band(hour: Column, names: tuple[str, str, str] = QUERY_BANDS) -> Column:
    (m1, m2), (e1, e2) = MEDIUM_HOURS
    return (
        F.when(is_late_night(hour), names[0])
        .when(hour.between(m1, m2) | hour.between(e1, e2), names[1])
        .otherwise(names[2])
    )


def time_block(hour: Column, width: int = 6) -> Column:
    """Label of the ``width``-hour block of the day, e.g. ``00:00–05:59 (Night)``."""
    if 24 % width:
        raise ValueError("width must divide 24")
    starts = list(range(0, 24, width))
    named = len(starts) == len(BLOCK_NAMES)
    texts = [
        f"{s:02d}:00–{s + width - 1:02d}:59" + (f" ({BLOCK_NAMES[i]})" if named else "")
        for i, s in enumerate(starts)
    ]
    # The last block also takes whatever is outside 0-23, null included.
    label = None
    for start, text in zip(starts[:-1], texts[:-1]):
        inside = hour.between(start, start + width - 1)
        label = F.when(inside, text) if label is None else label.when(inside, text)
    return F.lit(texts[-1]) if label is None else label.otherwise(texts[-1])


def risk_level_by_amount(
    amount: Column, hour: Column, high: float = 500, mid: float = 200, hours: tuple[int, int] = (0, 4)
) -> Column:
    night = hour.between(*hours)
    return (
        F.when((amount > high) & night, RISK_LEVELS[0])
        .when(amount > mid, RISK_LEVELS[1])
        .when(night, RISK_LEVELS[2])
        .otherwise(RISK_LEVELS[3])
    )


def risk_level_by_flags(high_value: Column, risky_hour: Column) -> Column:
    return (
        F.when((high_value == 1) & (risky_hour == 1), RISK_LEVELS[0])
        .when(high_value == 1, RISK_LEVELS[1])
        .when(risky_hour == 1, RISK_LEVELS[2])
        .otherwise(RISK_LEVELS[3])
    )


def audit_label(label: Column) -> Column:
    return F.when(label == 1, AUDIT_LABELS[0]).otherwise(AUDIT_LABELS[1])
