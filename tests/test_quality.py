from __future__ import annotations

import pytest

from tierwise.operators import quality as q


def data(spark, rows, schema="source_year SMALLINT, source_month TINYINT, a INT, b INT"):
    return spark.createDataFrame(rows, schema)


def report(df, checks, **options):
    out = q.evaluate(df, checks, q.MONTHLY, "d", "l", **options).collect()
    return {(r.batch, r.expectation, r.column): r for r in out}


def only(df, check):
    (row,) = report(df, [check]).values()
    return row


def test_suite_sizes():
    sizes = [
        len(s())
        for s in (q.trip_bronze_suite, q.trip_silver_suite, q.weather_bronze_suite, q.weather_silver_suite)
    ]
    assert sizes == [31, 56, 41, 88]


def test_batches_are_judged_apart(spark):
    df = data(spark, [(2023, 1, 1, 1), (2023, 1, None, 1), (2023, 2, 1, 1)])
    rows = report(df, q.not_null(["a"]))
    assert not rows["2023_01", q.NOT_NULL, "a"].success
    assert rows["2023_02", q.NOT_NULL, "a"].success


@pytest.mark.parametrize("mostly, success", [(0.75, True), (0.76, False)])
def test_mostly_at_the_threshold(spark, mostly, success):
    df = data(spark, [(2023, 1, v, 1) for v in (1, 2, 3, None)])
    row = only(df, q.not_null(["a"], mostly)[0])
    assert (row.success, row.unexpected_count, row.unexpected_pct) == (success, 1, 25.0)


def test_requested_batch_without_rows(spark):
    df = data(spark, [(2023, 1, 1, 1)])
    wanted = spark.createDataFrame([(2023, 1), (2023, 2)], "source_year SMALLINT, source_month TINYINT")
    checks = [q.row_count(1, 5), *q.not_null(["a"]), q.compound_unique(["a", "b"])]
    rows = report(df, checks, requested=wanted)
    assert not rows["2023_02", q.ROW_COUNT, None].success
    assert rows["2023_02", q.NOT_NULL, "a"].success
    assert rows["2023_02", q.COMPOUND_UNIQUE, "a,b"].success


def test_between_ignores_nulls_and_includes_bounds(spark):
    df = data(spark, [(2023, 1, v, 1) for v in (0, 5, None, 6)])
    row = only(df, q.between("a", 0, 5))
    assert (row.success, row.missing_count, row.unexpected_count) == (False, 1, 1)
    assert only(df, q.between("a", 0)).success and only(df, q.between("a", 0, 6)).success


def test_column_of_nulls_passes_value_checks(spark):
    df = data(spark, [(2023, 1, None, 1)])
    row = only(df, q.in_set("a", (1, 2)))
    assert row.success and row.unexpected_pct is None


def test_pairs(spark):
    df = data(spark, [(2023, 1, 2, 1), (2023, 1, 1, 1), (2023, 1, None, 1), (2023, 1, None, None)])
    row = only(df, q.pair_greater("a", "b"))
    assert (row.missing_count, row.unexpected_count) == (1, 2)


def test_missing_column(spark):
    df = data(spark, [(2023, 1, 1, 1)])
    checks = [*q.exist(["a", "A", "zz"]), *q.not_null(["zz"]), q.between("zz", 0, 1), q.compound_unique(["a", "zz"])]
    rows = report(df, checks)
    passed = {(kind, column) for (_, kind, column), r in rows.items() if r.success}
    assert passed == {(q.EXISTS, "a")}


def test_text_values_are_quoted(spark):
    df = data(spark, [(2023, 1, "it's")], "source_year SMALLINT, source_month TINYINT, a STRING")
    assert only(df, q.in_set("a", ("it's",))).success


@pytest.mark.parametrize("months, success", [(range(1, 13), True), (range(1, 12), False)])
def test_months_present(spark, months, success):
    df = data(spark, [(2023, m, 1, 1) for m in months])
    (row,) = q.evaluate(df, [q.unique_count("source_month", 12, 12)], q.YEARLY, "d", "l").collect()
    assert (row.batch, row.success, row.observed) == ("2023", success, str(len(months)))


def test_compound_keys(spark):
    df = data(spark, [(2023, 1, 1, 1), (2023, 1, 1, 1), (2023, 1, 1, None), (2023, 1, None, None), (2023, 1, None, None)])
    row = only(df, q.compound_unique(["a", "b"]))
    assert (row.success, row.missing_count, row.unexpected_count) == (False, 2, 2)


def test_gate_and_stored_report(spark, tmp_path):
    df = data(spark, [(2023, 1, 1, 1), (2023, 2, None, 1), (2023, 2, 1, 1)])
    path = str(tmp_path / "reports")
    q.write_report(q.evaluate(df, q.not_null(["a"]), q.MONTHLY, "d", "l"), path)
    verdict = q.verdicts(q.read_report(spark, path))
    assert {(r.batch, r.passed, r.total, r.success) for r in verdict.collect()} == {
        ("2023_01", 1, 1, True),
        ("2023_02", 0, 1, False),
    }
    admitted = q.admit(df, verdict, q.MONTHLY)
    assert [r.source_month for r in admitted.collect()] == [1]
    # Validating a batch again replaces its report and leaves the other.
    fixed = df.where("source_month = 2 AND a IS NOT NULL")
    q.write_report(q.evaluate(fixed, q.not_null(["a"]), q.MONTHLY, "d", "l"), path)
    again = q.verdicts(q.read_report(spark, path)).collect()
    assert len(again) == 2 and all(r.success for r in again)
