"""SQL text of the ``obs`` / ``daily`` views for the DuckDB oracles.

These mirror ``squall.sources.testviews`` expression by expression; they are
prepended as CTEs to each oracle query.
"""

_PARTS = {
    "loc": """loc AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS loc_id, n.n_name AS city, r.r_name AS country,
         CAST(n.n_nationkey AS DOUBLE) AS latitude, CAST(r.r_regionkey AS DOUBLE) AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "obs": """obs AS (
  SELECT e.event_id, e.ts AS event_time,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS original_timestamp,
         l.city, l.country, l.latitude, l.longitude, e.value AS temperature,
         CAST(CAST(json_extract(e.props, '$.k') AS INTEGER) AS DOUBLE) AS windspeed,
         CAST(CAST(json_extract(e.props, '$.k') AS INTEGER) % 10 AS INTEGER) AS weather_code,
         CAST(e.event_id % 360 AS DOUBLE) AS wind_direction,
         CAST(e.user_id % 101 AS DOUBLE) AS humidity,
         CAST(e.event_id % 7 AS DOUBLE) AS precipitation
  FROM events e JOIN loc l ON e.user_id % 25 = l.loc_id)""",
    "cobs": None,  # filled below (needs the level CASE text)
    "ow": """ow AS (
  SELECT l_orderkey, max(l_quantity) AS q_max,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS snow
  FROM lineitem GROUP BY l_orderkey)""",
    "daily": """daily AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, l.city, l.country, l.latitude, l.longitude,
         max(o.o_totalprice) / CAST(10000 AS DOUBLE) AS temp_max,
         min(o.o_totalprice) / CAST(10000 AS DOUBLE) AS temp_min,
         sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) / count(*) / CAST(1000000 AS DOUBLE)
           AS temp_mean,
         CAST(sum(o.o_custkey % 50) AS DOUBLE) AS precipitation,
         CAST(sum(o.o_custkey % 20) AS DOUBLE) AS rain,
         CAST(sum(ow.snow) AS DOUBLE) AS snowfall,
         max(ow.q_max) AS windspeed_max,
         max(ow.q_max) * 2 AS windgusts_max,
         CAST(min(o.o_orderkey % 100) AS INTEGER) AS weather_code
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN loc l ON CAST(c.c_nationkey AS BIGINT) = l.loc_id
  LEFT JOIN ow ON o.o_orderkey = ow.l_orderkey
  GROUP BY CAST(o.o_orderdate AS DATE), l.city, l.country, l.latitude, l.longitude)""",
}
_DEPS = {"obs": ["loc"], "cobs": ["obs"], "daily": ["loc", "ow"]}

WIND_LEVEL = ("CASE WHEN windspeed < 10 THEN 'level_0' WHEN windspeed <= 20 THEN 'level_1' "
              "WHEN windspeed > 20 THEN 'level_2' ELSE 'unknown' END")
HEAT_LEVEL = ("CASE WHEN temperature < 25 THEN 'level_0' WHEN temperature <= 35 THEN 'level_1' "
              "WHEN temperature > 35 THEN 'level_2' ELSE 'unknown' END")
_PARTS["cobs"] = (f"cobs AS (\n  SELECT *, {WIND_LEVEL} AS wind_alert_level, "
                  f"{HEAT_LEVEL} AS heat_alert_level FROM obs)")

MONTH_NAME = ("CASE month WHEN 1 THEN 'Janvier' WHEN 2 THEN 'Février' WHEN 3 THEN 'Mars' "
              "WHEN 4 THEN 'Avril' WHEN 5 THEN 'Mai' WHEN 6 THEN 'Juin' WHEN 7 THEN 'Juillet' "
              "WHEN 8 THEN 'Août' WHEN 9 THEN 'Septembre' WHEN 10 THEN 'Octobre' "
              "WHEN 11 THEN 'Novembre' WHEN 12 THEN 'Décembre' END")


def ctes(*names: str, extra: list[str] | tuple[str, ...] = ()) -> str:
    """CTE text for the named views (dependencies first) plus extra CTEs."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return ",\n".join([_PARTS[n] for n in order] + list(extra))


OBS = ctes("obs")
COBS = ctes("cobs")
DAILY = ctes("daily")


def with_views(views: str, body: str) -> str:
    return f"WITH {views}\n{body}"


def sliding(src: str, size_min: int = 5, slide_min: int = 1) -> str:
    """Expand each row into the ``size/slide`` windows that contain it."""
    n = size_min // slide_min
    return f"""wins AS (
  SELECT s.*, time_bucket(INTERVAL {slide_min} MINUTE, s.event_time)
              - s.i * INTERVAL {slide_min} MINUTE AS window_start
  FROM (SELECT *, unnest(range(0, {n})) AS i FROM {src}) s)"""
