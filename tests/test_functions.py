from __future__ import annotations

import decimal

import duckdb
import pytest

from pyspark.sql.functions import expr as fn_expr

from tierwise import functions as fn


def value(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first().v


@pytest.mark.parametrize(
    "x, expected",
    [("0.285D", 0.28), ("1.005D", 1.0), ("2.675D", 2.68), ("0.125D", 0.13), ("-0.125D", -0.13), ("NULL", None)],
)
def test_round2(spark, x, expected):
    assert value(spark, fn.round2(f"CAST({x} AS DOUBLE)")) == expected
    assert value(spark, fn.round2_agg(f"CAST({x} AS DOUBLE)")) == expected
    theirs = duckdb.connect().execute(f"SELECT round(CAST({x.rstrip('D')} AS DOUBLE), 2)").fetchone()[0]
    assert expected == theirs


def test_round2_agg_ignores_the_order_of_summation(spark):
    # 0.1 + 0.2 + 0.705 and its reverse differ in the last bit around a half.
    a, b = 0.1 + 0.2 + 0.705, 0.705 + 0.2 + 0.1
    left = value(spark, fn.round2_agg(f"CAST('{a!r}' AS DOUBLE)"))
    assert left == value(spark, fn.round2_agg(f"CAST('{b!r}' AS DOUBLE)"))


def test_exact_sums_do_not_depend_on_partitions(spark):
    # About 5e11 in all, in amounts that binary fractions cannot hold.
    rows = spark.range(3_000_000).selectExpr("CAST(id % 1000 * 333.37 + 0.01 AS DOUBLE) * (id % 3 + 1) AS x")
    sums = {rows.repartition(n).selectExpr(fn.sum2("x") + " AS s").first().s for n in (1, 3, 7)}
    exact = sum(
        (decimal.Decimal(repr((i % 1000 * 333.37 + 0.01) * (i % 3 + 1))).quantize(decimal.Decimal("1e-8"))) * 1000
        for i in range(3000)
    )
    assert exact > 10**11 and sums == {float(round(exact, 2))}


@pytest.mark.parametrize(
    "values, total, mean",
    [
        ([5.0, 15.0, 2e10], 2e10 + 20, (2e10 + 20) / 3), ([1e15, 0.25, 0.25], 1e15 + 0.5, (1e15 + 0.5) / 3),
        ([1e10, -1e10, 0.01], 0.01, 0.01 / 3), ([-0.1, -0.2, 0.3, None], 0.0, 0.0), ([None, None], None, None),
        ([float("nan"), 2.0], 2.0, 2.0), ([float("inf"), 3.5], 3.5, 3.5), ([9e18, 1e17], 9.1e18, 4.55e18),
        ([999999.99] * 7, 6999999.93, 999999.99), ([0.1] * 10, 1.0, 0.1),
    ],
)
def test_sums_lose_no_value(spark, values, total, mean):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    found = rows.selectExpr(f"{fn.sum2('x')} AS s", f"{fn.average('x')} AS a").first()
    assert found.s == total and found.a == (None if mean is None else pytest.approx(mean, rel=1e-15))


def test_a_sum_that_no_long_holds_is_an_error(spark):
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.createDataFrame([(9e18,), (9e18,)], "x double").selectExpr(fn.sum2("x")).collect()


def test_sums_keep_longs_while_rows_are_added(spark):
    plan = spark.range(9).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) AS x").groupBy("k").agg(fn_expr(fn.sum2("x")))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "decimal" not in plan.split("partial_sum")[-1].lower()


@pytest.mark.parametrize("kind", ["TIMESTAMP_NTZ", "TIMESTAMP"])
@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2023-01-01 00:00:59", "2023-01-01 00:01:00", 1),
        ("2023-01-01 00:00:01", "2023-01-01 00:00:59", 0),
        ("2023-01-01 23:59:59", "2023-01-02 00:00:00", 1),
        ("2023-01-02 00:00:00", "2023-01-01 00:00:00", -1440),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1),
    ],
)
def test_minutes_between(spark, kind, start, end, minutes):
    text = fn.minutes_between(f"{kind}'{start}'", f"{kind}'{end}'")
    assert value(spark, text) == minutes


def test_weekdays(spark):
    # 2023-01-01 was a Sunday.
    rows = spark.sql(
        f"SELECT {fn.day_of_week('d')} AS n, {fn.day_name('d')} AS name"
        " FROM (SELECT explode(sequence(DATE'2023-01-01', DATE'2023-01-07')) AS d)"
    ).collect()
    assert [(r.n, r.name) for r in rows] == list(
        enumerate(["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"])
    )


def test_whole_rounds_halves_to_even(spark):
    texts = ["2.5", "3.5", "-2.5", "40000", "abc"]
    assert [value(spark, fn.whole(f"'{t}'", "SMALLINT")) for t in texts] == [2, 4, -2, None, None]


def test_ratio_of_nothing_is_null(spark):
    assert value(spark, fn.ratio("1", "0")) is None
