import pytest

from heliolake.operators import quality


def _df(spark, rows):
    return spark.createDataFrame(rows, "dt string, site string, inv string, v double")


def test_coverage_equal_more_fewer(spark):
    base = [("2024-01-01", "s1", "a", 1.0), ("2024-01-01", "s1", "b", 1.0)]
    eq = base + [("2024-01-02", "s1", "a", 1.0), ("2024-01-02", "s1", "b", 2.0)]
    more = eq + [("2024-01-02", "s2", "c", 1.0)]
    fewer = base + [("2024-01-02", "s1", "a", 1.0)]
    for rows, passed in ((eq, True), (more, True), (fewer, False)):
        r = quality.coverage_check(_df(spark, rows), "inv", "2024-01-03", "c", "m").first()
        assert r["passed"] is passed


def test_freshness_empty_day(spark):
    rows = [("2024-01-01", "s1", "a", 1.0)]
    r = quality.freshness_check(_df(spark, rows), "2024-01-03", "f", "m").first()
    assert r["passed"] is False and r["observed"] == 0


def test_duplicates_including_nulls(spark):
    rows = [("2024-01-01", "s1", None, None), ("2024-01-01", "s1", None, None)]
    r = quality.duplicate_check(_df(spark, rows), "u", "m").first()
    assert r["passed"] is False and r["observed"] == 2 and r["expected"] == 1
    ok = quality.duplicate_check(_df(spark, rows[:1]), "u", "m").first()
    assert ok["passed"] is True


def test_report_and_assert(spark):
    df = _df(spark, [("2024-01-02", "s", "a", 1.0)])
    checks = [quality.freshness_check(df, "2024-01-03", "fresh", "ok"),
              quality.freshness_check(df, "2024-01-05", "stale", "no data")]
    rep = quality.report(checks)
    assert rep.columns == quality.CHECK_COLUMNS and rep.count() == 2
    with pytest.raises(quality.CheckFailed, match="stale"):
        quality.assert_report(rep)
    quality.assert_report(quality.report(checks[:1]))


def test_eight_messages():
    assert len(quality.MESSAGES) == 8
