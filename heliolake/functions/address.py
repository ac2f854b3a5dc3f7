"""Geocoder query string from a site location."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compose_address(address2, address, city) -> Column:
    """Missing parts count as ''. If address2 is set: "{address2} {address} {city}"; else if
    address is set: "{address} {city}"; else just the city. ``concat`` (not ``concat_ws``)
    keeps the double space of "{address2}  {city}" when address is empty."""
    def c(x):
        return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))
    a2, a, ci = c(address2), c(address), c(city)
    return (F.when(a2 != "", F.concat(a2, F.lit(" "), a, F.lit(" "), ci))
             .when(a != "", F.concat(a, F.lit(" "), ci))
             .otherwise(ci))
