"""Sliding event-time window aggregates (global, level mix, per city,
critical alerts).

Batch inputs are aggregated per slide-length pane first and only the pane
aggregates are expanded to their windows (see ``_aggregate_windows``);
streams use ``window(ts, size, slide)`` directly behind a watermark, one
stateful aggregate per query, or all four aggregates from one read with
``window_all_sets``.  Every aggregation has a map-side partial step, so a
hot city or a burst of rows in one minute is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions.classify import any_alert

DEFAULT_SIZE = "5 minutes"
DEFAULT_SLIDE = "1 minute"
DEFAULT_WATERMARK = "10 minutes"


def _windowed(df: DataFrame, ts_col: str, size: str, slide: str,
              watermark: str | None) -> tuple[DataFrame, Column]:
    if df.isStreaming and watermark:
        df = df.withWatermark(ts_col, watermark)
    return df, F.window(F.col(ts_col), size, slide).alias("w")


def _flatten(agg: DataFrame, *cols: str) -> DataFrame:
    return agg.select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *cols)


# --- pane pre-aggregation (batch) -------------------------------------------
# A sliding window of ``size`` advancing by ``slide`` (size a multiple of
# slide) is the union of ``size / slide`` consecutive panes of length
# ``slide``.  Batch inputs are first aggregated per pane and key, and only
# the pane aggregates are expanded to their windows and merged: the
# expansion and the second shuffle touch one row per (pane, key) instead of
# every input row.  Streams use the direct form (one stateful aggregate).

def _duration_seconds(text: str) -> int:
    n, unit = text.split()
    unit = unit.rstrip("s")
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]


def _pane_ready(df: DataFrame, size: str, slide: str) -> bool:
    if df.isStreaming:
        return False
    try:
        a, b = _duration_seconds(size), _duration_seconds(slide)
    except (KeyError, ValueError):
        return False
    return a % b == 0 and a > b


# Partial and merge steps per aggregate kind: (partial exprs, final expr).
def _spec(kind: str, name: str, c: Column | None):
    p = f"_{name}"
    if kind == "count":
        return [F.count(F.lit(1)).alias(p)], F.sum(p).alias(name)
    if kind == "count_if":
        return [F.sum(F.when(c, 1).otherwise(0)).alias(p)], F.sum(p).cast("bigint").alias(name)
    if kind in ("min", "max"):
        fn = getattr(F, kind)
        return [fn(c).alias(p)], fn(p).alias(name)
    if kind == "avg":
        return ([F.sum(c).alias(p + "_s"), F.count(c).alias(p + "_n")],
                F.try_divide(F.sum(p + "_s"), F.sum(p + "_n")).alias(name))
    raise ValueError(kind)


def _aggregate_windows(df: DataFrame, ts_col: str, size: str, slide: str,
                       watermark: str | None, keys: list, specs: list,
                       panes: bool | None = None) -> DataFrame:
    """Group by (window, *keys) computing ``specs`` = [(name, kind, col)].
    ``panes`` forces (True) or disables (False) pane pre-aggregation;
    ``None`` uses it whenever it applies."""
    use_panes = _pane_ready(df, size, slide) if panes is None else \
        (panes and _pane_ready(df, size, slide))
    if not use_panes:
        df, w = _windowed(df, ts_col, size, slide, watermark)
        direct = {"count": lambda c: F.count(F.lit(1)),
                  "count_if": lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint"),
                  "min": F.min, "max": F.max, "avg": F.avg}
        agg = df.groupBy(w, *keys).agg(*[direct[k](c).alias(n) for n, k, c in specs])
        return _flatten(agg, *keys, *[n for n, _, _ in specs])
    n_panes = _duration_seconds(size) // _duration_seconds(slide)
    parts = [_spec(k, n, c) for n, k, c in specs]
    pane_df = df.groupBy(F.window(F.col(ts_col), slide).start.alias("_pane"), *keys).agg(
        *[e for partial, _ in parts for e in partial])
    step = F.expr(f"INTERVAL {_duration_seconds(slide)} SECONDS")
    expanded = pane_df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n_panes - 1))))
    expanded = expanded.withColumn("window_start", F.col("_pane") - step * F.col("_i"))
    merged = expanded.groupBy("window_start", *keys).agg(*[final for _, final in parts])
    width = F.expr(f"INTERVAL {_duration_seconds(size)} SECONDS")
    return merged.select("window_start", (F.col("window_start") + width).alias("window_end"),
                         *keys, *[n for n, _, _ in specs])


def window_global_stats(df: DataFrame, ts_col: str = "event_time",
                        size: str = DEFAULT_SIZE, slide: str = DEFAULT_SLIDE,
                        watermark: str | None = DEFAULT_WATERMARK,
        panes: bool | None = None) -> DataFrame:
    t, w = F.col("temperature"), F.col("windspeed")
    return _aggregate_windows(df, ts_col, size, slide, watermark, [], [
        ("total_messages", "count", None), ("avg_temperature", "avg", t),
        ("min_temperature", "min", t), ("max_temperature", "max", t),
        ("avg_windspeed", "avg", w), ("max_windspeed", "max", w)], panes)


def window_level_distribution(df: DataFrame, ts_col: str = "event_time",
                              size: str = DEFAULT_SIZE, slide: str = DEFAULT_SLIDE,
                              watermark: str | None = DEFAULT_WATERMARK,
        panes: bool | None = None) -> DataFrame:
    return _aggregate_windows(df, ts_col, size, slide, watermark,
                              ["wind_alert_level", "heat_alert_level"],
                              [("count", "count", None)], panes)


def window_city_stats(df: DataFrame, ts_col: str = "event_time",
                      size: str = DEFAULT_SIZE, slide: str = DEFAULT_SLIDE,
                      watermark: str | None = DEFAULT_WATERMARK,
        panes: bool | None = None) -> DataFrame:
    return _aggregate_windows(df, ts_col, size, slide, watermark, ["city", "country"], [
        ("message_count", "count", None),
        ("avg_temp", "avg", F.col("temperature")),
        ("avg_wind", "avg", F.col("windspeed")),
        ("heat_alerts", "count_if", F.col("heat_alert_level") != "level_0"),
        ("wind_alerts", "count_if", F.col("wind_alert_level") != "level_0")], panes)


def window_critical_alerts(df: DataFrame, ts_col: str = "event_time",
                           size: str = DEFAULT_SIZE, slide: str = DEFAULT_SLIDE,
                           watermark: str | None = DEFAULT_WATERMARK,
        panes: bool | None = None) -> DataFrame:
    """Rows with any raised level only (filter before the window expansion)."""
    wl, hl = F.col("wind_alert_level"), F.col("heat_alert_level")
    return _aggregate_windows(df.filter(any_alert()), ts_col, size, slide, watermark,
                              ["city", "country"], [
                                  ("wind_level_1", "count_if", wl == "level_1"),
                                  ("wind_level_2", "count_if", wl == "level_2"),
                                  ("heat_level_1", "count_if", hl == "level_1"),
                                  ("heat_level_2", "count_if", hl == "level_2")], panes)


WINDOW_AGGREGATES = {
    "global": window_global_stats,
    "levels": window_level_distribution,
    "city": window_city_stats,
    "critical": window_critical_alerts,
}

# Group keys of each aggregate (used to keep the last update per key).
WINDOW_KEYS = {
    "global": ["window_start", "window_end"],
    "levels": ["window_start", "window_end", "wind_alert_level", "heat_alert_level"],
    "city": ["window_start", "window_end", "city", "country"],
    "critical": ["window_start", "window_end", "city", "country"],
}


# --- all four aggregates from one read (streams) -----------------------------
# One stateful aggregate with grouping sets (window), (window, levels) and
# (window, city) yields the global, level-mix and city rows at once; the
# critical-alert rows are the city-set rows with at least one raised level
# (rows without a raised level add nothing to the four level counts).  On a
# stream this replaces four source reads and four state stores by one.

def window_all_sets(df: DataFrame, ts_col: str = "event_time", size: str = DEFAULT_SIZE,
                    slide: str = DEFAULT_SLIDE,
                    watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    if df.isStreaming and watermark:
        df = df.withWatermark(ts_col, watermark)
    df = df.withColumn("w", F.window(F.col(ts_col), size, slide))
    wl, hl = F.col("wind_alert_level"), F.col("heat_alert_level")
    t, w = F.col("temperature"), F.col("windspeed")

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    levels, place = ["wind_alert_level", "heat_alert_level"], ["city", "country"]
    return df.groupingSets([["w"], ["w", *levels], ["w", *place]], "w", *levels, *place).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(t).alias("avg_t"), F.min(t).alias("min_t"), F.max(t).alias("max_t"),
        F.avg(w).alias("avg_w"), F.max(w).alias("max_w"),
        cnt(hl != "level_0").alias("heat_alerts"), cnt(wl != "level_0").alias("wind_alerts"),
        cnt(wl == "level_1").alias("wind_level_1"), cnt(wl == "level_2").alias("wind_level_2"),
        cnt(hl == "level_1").alias("heat_level_1"), cnt(hl == "level_2").alias("heat_level_2"),
        F.grouping("wind_alert_level").alias("_no_levels"),
        F.grouping("city").alias("_no_place"))


def split_window_sets(combined: DataFrame) -> dict[str, DataFrame]:
    """The four aggregates (same columns as the separate functions) from
    the output of ``window_all_sets``."""
    ws = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    is_global = (F.col("_no_levels") == 1) & (F.col("_no_place") == 1)
    is_levels = F.col("_no_levels") == 0
    is_place = F.col("_no_place") == 0
    raised = (F.col("wind_level_1") + F.col("wind_level_2") + F.col("heat_level_1")
              + F.col("heat_level_2")) > 0
    return {
        "global": combined.filter(is_global).select(
            *ws, F.col("n").alias("total_messages"), F.col("avg_t").alias("avg_temperature"),
            F.col("min_t").alias("min_temperature"), F.col("max_t").alias("max_temperature"),
            F.col("avg_w").alias("avg_windspeed"), F.col("max_w").alias("max_windspeed")),
        "levels": combined.filter(is_levels).select(
            *ws, "wind_alert_level", "heat_alert_level", F.col("n").alias("count")),
        "city": combined.filter(is_place).select(
            *ws, "city", "country", F.col("n").alias("message_count"),
            F.col("avg_t").alias("avg_temp"), F.col("avg_w").alias("avg_wind"),
            "heat_alerts", "wind_alerts"),
        "critical": combined.filter(is_place & raised).select(
            *ws, "city", "country", "wind_level_1", "wind_level_2", "heat_level_1",
            "heat_level_2"),
    }
