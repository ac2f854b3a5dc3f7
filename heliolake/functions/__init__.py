"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from heliolake.functions.phase import phase_mean, phase_sum, power_factor, typed_null
from heliolake.functions.rules import (
    DEFAULT_RULES,
    RangeRule,
    range_clean,
    rule_for,
)
from heliolake.functions.dates import (
    business_day,
    catch_up_range,
    cutoff_day,
    date_parts,
    date_range,
    day_bounds,
    next_day,
    parse_datetime,
    parse_day,
)
from heliolake.functions.measures import epoch_millis, fill_zero_column, to_measure
from heliolake.functions.address import compose_address

__all__ = [
    "phase_mean", "phase_sum", "power_factor", "typed_null",
    "DEFAULT_RULES", "RangeRule", "range_clean", "rule_for",
    "business_day", "catch_up_range", "cutoff_day", "date_parts", "date_range",
    "day_bounds", "next_day", "parse_datetime", "parse_day",
    "epoch_millis", "fill_zero_column", "to_measure", "compose_address",
]
