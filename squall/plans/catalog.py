"""Import every plan module so its queries register, then expose them."""

from __future__ import annotations

from squall.plans import history, ingest, reports, speed, streams  # noqa: F401
from squall.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
