"""Parsing and serialisation of messages, tolerant of bad input.

Spark 4 runs with ANSI semantics, where a plain ``cast`` of a malformed
string raises; every conversion of untrusted text therefore uses the
``try_`` forms, which return null instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from squall.functions._col import as_col


def parse_json_column(df: DataFrame, schema: StructType, value_col: str = "value",
                      keep: tuple[str, ...] = (), raw_col: str | None = None,
                      bad_col: str | None = None) -> DataFrame:
    """``from_json`` the (binary or string) column and star-expand the fields.

    ``keep`` columns are carried next to the parsed fields; ``raw_col`` keeps
    the original text so rejected rows can be routed (see ``reject_flag``);
    ``bad_col`` is the text of messages that are no JSON or have a value of
    the wrong type, null for the others (``schema`` is a ``StructType`` then).
    """
    text = F.col(value_col).cast("string")
    if bad_col:
        full = StructType([*schema.fields, StructField(bad_col, StringType())])
        data = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad_col})
    else:
        data = F.from_json(text, schema)
    cols = [data.alias("__data")] + [F.col(k) for k in keep]
    if raw_col:
        cols.append(text.alias(raw_col))
    out = df.select(*cols)
    return out.select("__data.*", *keep, *([raw_col] if raw_col else []))


def reject_flag(fields: list[str]) -> Column:
    """A parsed row whose fields are all null came from unparseable text."""
    from functools import reduce
    return reduce(lambda a, b: a & b, [F.col(f).isNull() for f in fields])


def to_json_value(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One JSON object per row in a ``value`` column (Kafka / text sinks)."""
    payload = F.struct(*(cols or df.columns))
    return df.select(F.to_json(payload).alias("value"))


def tolerant_timestamp(c, fallback_now: bool = False) -> Column:
    """Parse ISO ``T`` form (optionally ``Z``/offset) or ``yyyy-MM-dd HH:mm:ss``.

    Empty or malformed text gives null, or the processing time when
    ``fallback_now`` is set.
    """
    parsed = as_col(c).try_cast("timestamp")
    return F.coalesce(parsed, F.current_timestamp()) if fallback_now else parsed


def to_date_safe(c) -> Column:
    return as_col(c).try_cast("date")


# Defaults for missing message fields in the alert read-out.
FIELD_DEFAULTS = {
    "city": "Unknown", "country": "Unknown",
    "temperature": 0.0, "windspeed": 0.0,
    "wind_alert_level": "unknown", "heat_alert_level": "unknown",
    "region": "", "population": 0,
}


def with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """``coalesce`` each present column with its default."""
    defaults = defaults or FIELD_DEFAULTS
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in present.items()})


def count_rejects(parsed: DataFrame, fields: list[str], name: str = "parse_quality"):
    """Attach valid / rejected row counters to a parse with ``observe``.

    Batch: returns ``(df, Observation)``; read ``Observation.get`` after an
    action.  Stream: returns ``(df, name)``; each micro-batch's counts appear
    in the query progress under ``observedMetrics[name]``."""
    rejected = reject_flag(fields)
    metrics = (F.count_if(~rejected).alias("valid"), F.count_if(rejected).alias("rejected"))
    if parsed.isStreaming:
        return parsed.observe(name, *metrics), name
    from pyspark.sql import Observation
    obs = Observation(name)
    return parsed.observe(obs, *metrics), obs


def reject_reason(fields: list[str], time_col: str | None = None, bad_col: str | None = None,
                  require_time: bool = False) -> Column:
    """Why a parsed message cannot be used, null if it can: ``unparseable`` (no
    field could be read), ``wrong_type`` (``bad_col`` is set), ``bad_time``
    (``time_col`` is no timestamp), ``missing_time`` (asked for with
    ``require_time``)."""
    reason = F.when(reject_flag(fields), F.lit("unparseable"))
    if bad_col is not None:
        reason = reason.when(F.col(bad_col).isNotNull(), F.lit("wrong_type"))
    if time_col is not None:
        reason = reason.when(F.col(time_col).isNotNull() & tolerant_timestamp(time_col).isNull(), F.lit("bad_time"))
        if require_time:
            reason = reason.when(F.col(time_col).isNull(), F.lit("missing_time"))
    return reason


def split_rejects(parsed: DataFrame, fields: list[str], raw_col: str = "_raw",
                  time_col: str | None = None, bad_col: str | None = None,
                  require_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """Route parse failures to a side output.

    Returns ``(valid, rejected)``: ``rejected`` keeps the original text in
    ``raw_col`` and a ``reason`` (see ``reject_reason``)."""
    tagged = parsed.withColumn("reason", reject_reason(fields, time_col, bad_col, require_time))
    valid = tagged.filter(F.col("reason").isNull()).drop("reason", raw_col, *([bad_col] if bad_col else []))
    rejected = tagged.filter(F.col("reason").isNotNull()).select(raw_col, "reason")
    return valid, rejected
