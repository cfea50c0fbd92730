"""Path-safe location names and the ``country/city`` composite key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.functions._col import as_col

# Character rules for folder names.  Characters in the first
# string map position-wise to the second; extra ones are deleted.
SAFE_NAME_RULES = {
    "basic": (" /", "__"),          # space and slash -> underscore
    "default": (" /'", "__"),       # ... and drop apostrophes
    "strict": (" /-'", "___"),      # ... and hyphen -> underscore
}


def safe_name(c, rule: str = "default") -> Column:
    src, dst = SAFE_NAME_RULES[rule]
    return F.translate(as_col(c), src, dst)


def location_key(country="country", city="city") -> Column:
    return F.concat_ws("/", as_col(country), as_col(city))


def split_location_key(c="location") -> tuple[Column, Column]:
    parts = F.split(as_col(c), "/", 2)
    return F.get(parts, 0), F.get(parts, 1)


def display_key(city="city", country="country") -> Column:
    """``"city, country"`` label used by selection lists."""
    return F.concat_ws(", ", as_col(city), as_col(country))


def split_display_key(c="label") -> tuple[Column, Column]:
    """Inverse of ``display_key``: (city, country)."""
    parts = F.split(as_col(c), ", ", 2)
    return F.get(parts, 0), F.get(parts, 1)
