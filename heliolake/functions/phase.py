"""Three-phase derived measures.

Plain column arithmetic: ``+`` propagates NULL, so a single-phase inverter (no L2/L3)
gets NULL mean and sum, exactly like the silver job; ``coalesce`` picks the first
reported power factor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def phase_sum(*phases: str | Column) -> Column:
    """L1 + L2 + ... ; NULL as soon as one phase is NULL."""
    cols = [_col(c) for c in phases]
    return reduce(lambda a, b: a + b, cols)


def phase_mean(*phases: str | Column) -> Column:
    """(L1 + L2 + ...) / n ; NULL as soon as one phase is NULL (P5)."""
    return phase_sum(*phases) / F.lit(len(phases))


def power_factor(*cos_phis: str | Column) -> Column:
    """First non-NULL cosPhi in phase order L1 -> L2 -> L3."""
    return F.coalesce(*[_col(c) for c in cos_phis])


def typed_null(type_name: str) -> Column:
    """A NULL literal with a fixed type, so the Parquet schema is stable."""
    return F.lit(None).cast(type_name)
