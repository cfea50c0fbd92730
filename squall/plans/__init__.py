"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame; most have an equivalent DuckDB SQL text used as a correctness
oracle over the same Parquet tables."""

from squall.plans.catalog import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
