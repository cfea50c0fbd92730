"""Speed-layer queries over the ``obs`` view: classification and sliding
window aggregates (batch form; the streaming twins are in ``streams``)."""

from __future__ import annotations

from squall.functions.classify import critical_flag, with_alert_levels
from squall.operators import windows as W
from squall.plans.registry import ORACLES, register
from squall.plans.sqlviews import COBS, sliding, with_views
from squall.sources.testviews import obs


def classified(spark, sf_dir):
    return with_alert_levels(obs(spark, sf_dir))


@register("classify_obs", with_views(COBS, "SELECT * FROM cobs"))
def classify_obs(spark, sf_dir):
    """Observations with wind and heat alert levels."""
    return classified(spark, sf_dir)


@register("critical_obs", with_views(COBS, """
SELECT event_id, event_time, city, country, temperature, windspeed,
       wind_alert_level, heat_alert_level
FROM cobs WHERE wind_alert_level = 'level_2' OR heat_alert_level = 'level_2'"""))
def critical_obs(spark, sf_dir):
    """Observations with a level-2 wind or heat alert."""
    return (classified(spark, sf_dir).filter(critical_flag())
            .select("event_id", "event_time", "city", "country", "temperature",
                    "windspeed", "wind_alert_level", "heat_alert_level"))


WIN_GLOBAL_SQL = with_views(COBS + ",\n" + sliding("cobs"), """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       count(*) AS total_messages, avg(temperature) AS avg_temperature,
       min(temperature) AS min_temperature, max(temperature) AS max_temperature,
       avg(windspeed) AS avg_windspeed, max(windspeed) AS max_windspeed
FROM wins GROUP BY window_start""")

WIN_LEVELS_SQL = with_views(COBS + ",\n" + sliding("cobs"), """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       wind_alert_level, heat_alert_level, count(*) AS count
FROM wins GROUP BY window_start, wind_alert_level, heat_alert_level""")

WIN_CITY_SQL = with_views(COBS + ",\n" + sliding("cobs"), """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, city, country,
       count(*) AS message_count, avg(temperature) AS avg_temp, avg(windspeed) AS avg_wind,
       CAST(sum(CASE WHEN heat_alert_level <> 'level_0' THEN 1 ELSE 0 END) AS BIGINT) AS heat_alerts,
       CAST(sum(CASE WHEN wind_alert_level <> 'level_0' THEN 1 ELSE 0 END) AS BIGINT) AS wind_alerts
FROM wins GROUP BY window_start, city, country""")

WIN_CRITICAL_SQL = with_views(
    COBS + ",\ncrit AS (SELECT * FROM cobs WHERE wind_alert_level IN ('level_1', 'level_2') "
    "OR heat_alert_level IN ('level_1', 'level_2')),\n" + sliding("crit"), """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, city, country,
       CAST(sum(CASE WHEN wind_alert_level = 'level_1' THEN 1 ELSE 0 END) AS BIGINT) AS wind_level_1,
       CAST(sum(CASE WHEN wind_alert_level = 'level_2' THEN 1 ELSE 0 END) AS BIGINT) AS wind_level_2,
       CAST(sum(CASE WHEN heat_alert_level = 'level_1' THEN 1 ELSE 0 END) AS BIGINT) AS heat_level_1,
       CAST(sum(CASE WHEN heat_alert_level = 'level_2' THEN 1 ELSE 0 END) AS BIGINT) AS heat_level_2
FROM wins GROUP BY window_start, city, country""")


@register("win_global", WIN_GLOBAL_SQL)
def win_global(spark, sf_dir):
    """Global statistics per 5-minute window sliding by 1 minute."""
    return W.window_global_stats(classified(spark, sf_dir))


@register("win_levels", WIN_LEVELS_SQL)
def win_levels(spark, sf_dir):
    """Row count per (window, wind level, heat level)."""
    return W.window_level_distribution(classified(spark, sf_dir))


@register("win_city", WIN_CITY_SQL)
def win_city(spark, sf_dir):
    """Per-city statistics per sliding window (flagship query)."""
    return W.window_city_stats(classified(spark, sf_dir))


@register("win_critical", WIN_CRITICAL_SQL)
def win_critical(spark, sf_dir):
    """Level-1/2 alert counts per (window, city) over raised rows only."""
    return W.window_critical_alerts(classified(spark, sf_dir))


@register("win_global_10m_2m", with_views(COBS + ",\n" + sliding("cobs", 10, 2), """
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end,
       count(*) AS total_messages, avg(temperature) AS avg_temperature,
       min(temperature) AS min_temperature, max(temperature) AS max_temperature,
       avg(windspeed) AS avg_windspeed, max(windspeed) AS max_windspeed
FROM wins GROUP BY window_start"""))
def win_global_10m_2m(spark, sf_dir):
    """Window size and slide as parameters: 10-minute windows every 2 minutes."""
    return W.window_global_stats(classified(spark, sf_dir), size="10 minutes",
                                 slide="2 minutes")


@register("win_city_tumbling", with_views(COBS + ",\n" + sliding("cobs", 10, 10), """
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, city, country,
       count(*) AS message_count, avg(temperature) AS avg_temp, avg(windspeed) AS avg_wind,
       CAST(sum(CASE WHEN heat_alert_level <> 'level_0' THEN 1 ELSE 0 END) AS BIGINT) AS heat_alerts,
       CAST(sum(CASE WHEN wind_alert_level <> 'level_0' THEN 1 ELSE 0 END) AS BIGINT) AS wind_alerts
FROM wins GROUP BY window_start, city, country"""))
def win_city_tumbling(spark, sf_dir):
    """Window size and slide are parameters; slide = size gives tumbling windows."""
    return W.window_city_stats(classified(spark, sf_dir), size="10 minutes", slide="10 minutes")


# Oracle texts reused by the streaming twins of these queries.
ORACLES_FOR_STREAMS = {name: ORACLES[name] for name in ['classify_obs', 'win_global', 'win_levels', 'win_city', 'win_critical']}
