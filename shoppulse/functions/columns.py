"""Column expressions (all built-in, JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EVENT_TS_FORMAT, WINDOW_KEY_PREFIX


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den``; ``default`` when ``den`` is 0 or null (average order value)."""
    ratio = num.cast("double") / den.cast("double")
    guarded = F.when(den.isNotNull() & (den != 0), ratio)
    return guarded if default is None else guarded.otherwise(F.lit(default))


def pct_change(prev: Column, curr: Column) -> Column:
    """``(curr - prev) / prev * 100``; null if prev is null or 0, or curr is null."""
    p, c = prev.cast("double"), curr.cast("double")
    return F.when(p.isNotNull() & (p != 0) & c.isNotNull(), (c - p) / p * F.lit(100.0))


def round_half_up(x: Column, digits: int) -> Column:
    """Half-up rounding done in double arithmetic, so any engine gets the same bits."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def direction(change: Column) -> Column:
    """'up' for a change >= 0, 'down' below 0, null without a change."""
    return F.when(change >= 0, F.lit("up")).when(change < 0, F.lit("down"))


def parse_event_time(ts_text: Column) -> Column:
    """Event-time text -> TIMESTAMP; bad text gives null instead of failing (ANSI mode)."""
    return F.try_to_timestamp(ts_text, F.lit(EVENT_TS_FORMAT))


def format_event_time(ts: Column) -> Column:
    return F.date_format(ts, EVENT_TS_FORMAT)


def window_label(ts: Column) -> Column:
    """Display label of a window start (``HH:mm``, as the store's hash field)."""
    return F.date_format(ts, "HH:mm")


def store_key(category: Column) -> Column:
    return F.concat(F.lit(WINDOW_KEY_PREFIX), category)


def category_from_key(key: Column) -> Column:
    """Category = the key part after the last ':'."""
    return F.element_at(F.split(key, ":"), -1)
