"""Code -> label lookups as constant map expressions (no join, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.functions._col import as_col

# Weather-code labels shown by the reports (French, as stored).
WEATHER_CODE_LABELS = {
    0: "Ciel dégagé", 1: "Dégagé", 2: "Nuageux", 3: "Couvert",
    45: "Brouillard", 61: "Pluie légère", 63: "Pluie modérée",
    65: "Pluie forte", 95: "Orage",
}

# Month names used in the profile documents.
MONTH_NAMES_FR = {
    1: "Janvier", 2: "Février", 3: "Mars", 4: "Avril",
    5: "Mai", 6: "Juin", 7: "Juillet", 8: "Août",
    9: "Septembre", 10: "Octobre", 11: "Novembre", 12: "Décembre",
}


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def weather_label(c="weather_code") -> Column:
    """Label for a weather code; unknown codes read ``Code <n>``."""
    c = as_col(c)
    return F.coalesce(F.try_element_at(_map_literal(WEATHER_CODE_LABELS), c),
                      F.concat(F.lit("Code "), c.cast("string")))


def month_name_fr(c="month") -> Column:
    return F.try_element_at(_map_literal(MONTH_NAMES_FR), as_col(c))
