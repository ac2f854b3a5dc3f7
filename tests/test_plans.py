"""Plan inspection: no Python evaluation, no cross products, filters pushed
to the scan, and no shuffle between bronze and gold."""

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.mark.parametrize("name", _names())
def test_no_python_or_cross_product(spark, name):
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_day_range_pushed_to_scan(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["events_day_range"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_bronze_to_gold_has_no_exchange(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["gold_inverters"](spark, SF))
    assert "Exchange" not in plan
    plan = _plan(E.queries()["export_long"](spark, SF))
    assert "Exchange" not in plan and "Expand" in plan


def test_aggregate_is_partial_first(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["gold_agg"](spark, SF))
    assert "partial_avg" in plan


def test_bronze_scan_reads_declared_fields_only(spark, tmp_path):
    """The explicit schema keeps undeclared document fields (inverterMode, ...) out of the
    scan, and the optimizer prunes the generator to the fields a query uses."""
    import fixtures
    from heliolake.operators import silver
    from heliolake.sources import read_inverter_bronze
    fixtures.write_inverters(str(tmp_path))
    df = silver.flatten_telemetry(read_inverter_bronze(spark, f"{tmp_path}/inverters_data"))
    plan = _plan(df.select("Local_inverter_id", "DC_Voltage"))
    assert "ReadSchema: struct<data:struct<telemetries:array<struct<date:string" in plan
    assert "inverterMode" not in plan
    assert "explode(_extract_dcVoltage" in plan
