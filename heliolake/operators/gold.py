"""Silver -> gold (P9-P13) and the gold aggregate (A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.functions.rules import DEFAULT_RULES, RangeRule
from heliolake.schemas import AGG_KEYS, AGG_MEASURES, GOLD_INVERTER_COLUMNS

# The literal data-source tag of the first vendor and the placeholder
# coordinates of the gold site table.
DATA_SOURCE = "Solar Edge"
PLACEHOLDER_COORDINATE = 0

def gold_inverters(silver: DataFrame, rules: Sequence[RangeRule] = DEFAULT_RULES,
                   data_source: str = DATA_SOURCE) -> DataFrame:
    """Gold telemetry (P12 + P11 + P9): pass-through columns, columns cleaned by their rule and
    the ``Data_Source`` tag, in gold order. Keeps ``dt`` when present. One narrow projection."""
    by_col = {r.column: r for r in rules} | {"Data_Source": None}

    def column(c):
        rule = by_col.get(c, c)
        if rule is None:
            return F.lit(data_source).alias(c)
        return F.col(c) if rule == c else rule.expr().alias(c)

    extra = ["dt"] if "dt" in silver.columns else []
    return silver.select(*[column(c) for c in GOLD_INVERTER_COLUMNS], *extra)


def gold_sites(silver_sites: DataFrame) -> DataFrame:
    """Gold site table (P13 + P10): 8 columns and integer placeholder coordinates."""
    extra = ["dt"] if "dt" in silver_sites.columns else []
    return silver_sites.select(
        "Id", "Name", "Status", "Peak_Power", "Installation_Date", "Comment", "Type",
        "Account_id",
        F.lit(PLACEHOLDER_COORDINATE).alias("Latitude"),
        F.lit(PLACEHOLDER_COORDINATE).alias("Longitude"),
        *extra,
    )


def group_average(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``groupBy(keys).agg(avg(m) AS m ...)``.

    NULL keys form one group and ``avg`` skips NULLs. ``avg`` is algebraic, so Spark runs a
    partial aggregate in every map task before the shuffle: even when all rows share one
    key (the reference's keys are always NULL) only one partial row per task and group
    crosses the network, so a hot group cannot overload one reducer.
    """
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])


def inverter_agg(gold: DataFrame, keys: Sequence[str] = AGG_KEYS,
                 measures: Sequence[str] = AGG_MEASURES, per_day: bool = True) -> DataFrame:
    """Gold aggregate (A1): averages of 16 measures per (Account_id, Data_Source,
    DC_Current), per ``dt`` when the input spans several days."""
    k = list(keys) + (["dt"] if per_day and "dt" in gold.columns and "dt" not in keys else [])
    return group_average(gold, k, measures)
