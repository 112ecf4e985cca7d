from __future__ import annotations

import pytest

from tierwise import session
from tierwise.operators import versions
from tierwise.operators.versions import VersionedTable, schema_changes, schema_rows
from tierwise.schemas import PARTITION_KEYS
from tierwise.session import fresh_dir


def rows(spark, *data, schema="source_year INT, source_month INT, v INT"):
    return spark.createDataFrame(data, schema)


def state(df):
    return sorted((r.source_year, r.source_month, r.v) for r in df.collect())


@pytest.fixture
def table(spark):
    return VersionedTable(spark, fresh_dir(spark, "test-versions"))


@pytest.fixture
def revised(spark, table):
    table.commit(rows(spark, (2022, 12, 1), (2023, 1, 1), (2023, 2, 1), (2023, 3, 1)), operation="CREATE")
    table.commit(rows(spark, (2023, 2, 2), (2023, 2, 3)), replace=[(2023, 2)])
    table.commit(rows(spark, (2024, 1, 4)), replace=[(2024, 1)])
    table.commit(rows(spark, (2023, 1, 5), (2023, 3, 5)), replace=[(2023, None)])
    return table


STATES = {
    0: [(2022, 12, 1), (2023, 1, 1), (2023, 2, 1), (2023, 3, 1)],
    1: [(2022, 12, 1), (2023, 1, 1), (2023, 2, 2), (2023, 2, 3), (2023, 3, 1)],
    2: [(2022, 12, 1), (2023, 1, 1), (2023, 2, 2), (2023, 2, 3), (2023, 3, 1), (2024, 1, 4)],
    3: [(2022, 12, 1), (2023, 1, 5), (2023, 3, 5), (2024, 1, 4)],
}


def test_every_version_stays_readable(revised):
    for version, expected in STATES.items():
        assert state(revised.as_of(version)) == expected
    assert state(revised.read()) == STATES[3]


def test_row_counts_match_the_rows(revised):
    counts = {r.version: r.rows for r in revised.rows_per_version().collect()}
    assert counts == {v: len(expected) for v, expected in STATES.items()}


def test_read_by_time(revised):
    moments = {r.version: r.ts for r in revised.history().collect()}
    assert state(revised.as_of_time(moments[1])) == STATES[1]
    with pytest.raises(ValueError):
        revised.as_of_time("2000-01-01 00:00:00")


def test_history_is_newest_first(revised):
    assert [r.version for r in revised.history(2).collect()] == [3, 2]
    assert revised.history(1).first().predicate == "source_year = 2023"


def test_replay_changes_nothing(spark, revised):
    again = revised.read().where("source_year = 2023")
    revised.commit(again, replace=[(2023, None)])
    assert revised.latest_version() == 4 and state(revised.read()) == STATES[3]


def test_several_batches_in_one_commit(spark, revised):
    revised.commit(rows(spark, (2022, 12, 9), (2024, 1, 9)), replace=[(2022, 12), (2024, 1)])
    assert state(revised.read()) == [(2022, 12, 9), (2023, 1, 5), (2023, 3, 5), (2024, 1, 9)]


def test_rows_outside_the_batch_are_refused(spark, revised):
    with pytest.raises(ValueError, match="outside"):
        revised.commit(rows(spark, (2023, 1, 7)), replace=[(2023, 2)])
    assert state(revised.read()) == STATES[3]
    # The refused write left files behind; the next commit takes their place.
    revised.commit(rows(spark, (2023, 1, 8)), replace=[(2023, 1)])
    assert (2023, 1, 8) in state(revised.read()) and (2023, 1, 7) not in state(revised.read())


def test_empty_write_is_skipped(spark, revised):
    with pytest.warns(UserWarning, match="no rows"):
        assert revised.commit(rows(spark), replace=[(2023, 1)]) is None
    assert revised.latest_version() == 3


def test_rows_without_a_month_live_until_their_year_is_replaced(spark, revised):
    revised.commit(rows(spark, (2023, None, 7), (2023, 1, 7)), replace=[(2023, None)])
    assert sorted(revised.read().select("v").collect()) == [(1,), (4,), (7,), (7,)]
    assert revised.read().where("source_month IS NULL").count() == 1
    revised.commit(rows(spark, (2023, 2, 8)), replace=[(2023, None)])
    assert state(revised.read()) == [(2022, 12, 1), (2023, 2, 8), (2024, 1, 4)]
    counts = {r.version: r.rows for r in revised.rows_per_version().collect()}
    assert (counts[4], counts[5]) == (4, 3)
    with pytest.raises(ValueError, match="source_year"):
        revised.commit(rows(spark, (None, 1, 9)), replace=[(2023, None)])


def test_existing_table_needs_a_batch(spark, revised):
    with pytest.raises(ValueError, match="batches"):
        revised.commit(rows(spark, (2023, 1, 1)))


def test_unknown_version(revised):
    with pytest.raises(ValueError):
        revised.as_of(9)


def test_new_columns_and_other_spelling(spark, revised):
    wider = rows(spark, (2024, 1, 6, 1.5), schema="source_year INT, source_month INT, V INT, fee DOUBLE")
    revised.commit(wider, replace=[(2024, 1)])
    live = revised.read()
    assert live.columns == ["source_year", "source_month", "v", "fee"]
    assert {(r.source_year, r.fee) for r in live.collect()} == {(2022, None), (2023, None), (2024, 1.5)}
    assert "fee" not in revised.as_of(3).columns
    drift = [(r.version, r.name, r.change) for r in revised.schema_drift().collect()]
    assert drift == [(4, "fee", "ADDED")]


def test_types_widen_but_do_not_change(spark, revised):
    wide = rows(spark, (2024, 1, 2**40), schema="source_year INT, source_month INT, v BIGINT")
    revised.commit(wide, replace=[(2024, 1)])
    assert (2024, 1, 2**40) in state(revised.read()) and (2022, 12, 1) in state(revised.read())
    change = revised.schema_drift().first()
    assert (change.old_type, change.new_type, change.change) == ("int", "bigint", "CHANGED")
    text = rows(spark, (2024, 1, "x"), schema="source_year INT, source_month INT, v STRING")
    with pytest.raises(ValueError, match="changes from"):
        revised.commit(text, replace=[(2024, 1)])


def test_pruned_read_lists_only_its_partition(revised):
    plan = revised.read().where("source_year = 2024 AND source_month = 1")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "source_year" in filters and "source_month" in filters


@pytest.mark.parametrize("sort", [(), ("v",)])
def test_a_large_partition_is_written_by_several_tasks(spark, table, sort):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        hot = spark.range(200_000).selectExpr(
            "2023 AS source_year", "IF(id % 3 = 0, 2, 1) AS source_month", "uuid() AS v"
        ).repartition(8)
        table.commit(hot, sort=sort)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len([f for f in table.read().inputFiles() if "source_month=1" in f]) > 1


def test_schema_changes(spark):
    old = schema_rows(spark, spark.createDataFrame([], "a INT, b INT, c INT"))
    new = schema_rows(spark, spark.createDataFrame([], "a INT, b BIGINT, d INT"))
    found = {r.name: (r.old_type, r.new_type, r.change) for r in schema_changes(old, new).collect()}
    assert found == {
        "b": ("int", "bigint", "CHANGED"),
        "c": ("int", None, "REMOVED"),
        "d": (None, "int", "ADDED"),
    }


def test_a_repeated_batch_of_a_stream_is_committed_once(spark, table):
    first = rows(spark, (2023, 1, 1))
    assert table.commit(first, source=("stream", 0)) == 0
    assert table.commit(rows(spark, (2023, 2, 2)), replace=[(2023, 2)], source=("stream", 1)) == 1
    # The same batch again, whatever its rows are now: nothing is written.
    assert table.commit(rows(spark, (2023, 2, 9)), replace=[(2023, 2)], source=("stream", 1)) == 1
    assert table.latest_version() == 1 and state(table.read()) == [(2023, 1, 1), (2023, 2, 2)]
    # Another stream's batch of that number is another one.
    assert table.commit(rows(spark, (2023, 3, 3)), replace=[(2023, 3)], source=("other", 1)) == 2
    assert table.commit(rows(spark, (2023, 3, 4)), replace=[(2023, 3)]) == 3


def served(spark, query):
    return [tuple(r) for r in spark.sql(query).collect()]


def test_served_tables_point_at_live_partitions(spark, table):
    """Nothing is copied; a refresh moves the changed partitions only, and old ones are no longer seen."""
    from tierwise.operators import serving

    name = "served_test.taxi_daily_summary"
    table.commit(rows(spark, (2022, 12, 1), (2023, 1, 1), (2023, None, 7)))
    serving.register(spark, {"daily_summary": table}, "served_test")
    everything = f"SELECT source_year, source_month, v FROM {name} ORDER BY ALL"
    assert served(spark, everything) == [(2022, 12, 1), (2023, None, 7), (2023, 1, 1)]
    before = serving.served_folders(spark, name)
    assert set(before.values()) == set(table.live()[1].values())
    table.commit(rows(spark, (2023, 1, 2), (2023, 1, 3)), replace=[(2023, 1)])
    assert served(spark, everything) == [(2022, 12, 1), (2023, None, 7), (2023, 1, 1)]
    serving.refresh(spark, "daily_summary", table, "served_test")
    assert served(spark, everything) == [(2022, 12, 1), (2023, None, 7), (2023, 1, 2), (2023, 1, 3)]
    after = serving.served_folders(spark, name)
    assert [k for k in after if before[k] != after[k]] == [(2023, 1)]
    table.commit(rows(spark, (2023, 5, 9)), replace=[(2023, None)])
    serving.refresh(spark, "daily_summary", table, "served_test")
    assert served(spark, everything) == [(2022, 12, 1), (2023, 5, 9)]
    # A month's query lists that month alone.
    plan = spark.sql(f"SELECT v FROM {name} WHERE source_month = 5 AND source_year = 2023")
    assert "PartitionFilters: [isnotnull" in plan._jdf.queryExecution().executedPlan().toString()
    wider = spark.createDataFrame([(2022, 12, 4, "x")], "source_year INT, source_month INT, v INT, w STRING")
    table.commit(wider, replace=[(2022, 12)])
    serving.refresh(spark, "daily_summary", table, "served_test")
    assert served(spark, f"SELECT v, w FROM {name} ORDER BY v") == [(4, "x"), (9, None)]
    spark.sql("DROP SCHEMA served_test CASCADE")


def test_scans_tell_what_they_opened(spark, revised):
    from tierwise.operators import pruning

    figures = {r.read: r for r in pruning.pruning_scans(revised.as_of(1), 2023, 2).collect()}
    assert (figures["full"].rows, figures["full"].partitions) == (5, 4)
    assert (figures["month"].rows, figures["month"].partitions) == (2, 1)
    assert 0 < figures["month"].files < figures["full"].files and 0 < figures["month"].bytes < figures["full"].bytes


def test_filled_changes(spark):
    from tierwise.operators.versions import filled_changes

    old = spark.createDataFrame([(1, 2, "x"), (None, 3, None)], "a INT, b INT, gone STRING")
    new = spark.createDataFrame([(1, 2, None), (2, None, None), (3, None, 0.5)], "a BIGINT, b INT, fresh DOUBLE")
    found = {(r.name, r.old_type, r.new_type, r.change, r.old_filled, r.new_filled) for r in filled_changes(old, new).collect()}
    assert found == {
        ("a", "int", "bigint", "CHANGED", 1, 3), ("gone", "string", None, "REMOVED", 1, None), ("fresh", None, "double", "ADDED", None, 1)
    }
    assert filled_changes(old, old).count() == 0


def test_laid_out_rows_are_written_by_the_tasks_that_read_them(spark, tmp_path):
    """No shuffle: each of three tasks leaves a file of its own; no setting stays behind."""
    rows = spark.range(0, 300, numPartitions=3).selectExpr("id", "1996 AS source_year", "id % 2 + 1 AS source_month")
    table = VersionedTable(spark, str(tmp_path / "laid"))
    table.commit(rows, laid_out=True)
    month = tmp_path / "laid/data/_commit=0/source_year=1996/source_month=1"
    assert len(list(month.glob("*.parquet"))) == 3
    assert sorted(r.id for r in table.read().collect()) == list(range(300))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") in (None, "0")


def test_laid_out_rows_of_more_partitions_than_open_files(spark, tmp_path):
    rows = spark.range(0, 4000, numPartitions=1).selectExpr("id", "id % 400 AS source_year", "id % 12 + 1 AS source_month")
    table = VersionedTable(spark, str(tmp_path / "many"))
    table.commit(rows, laid_out=True)
    assert table.read().where("source_year = id % 400 AND source_month = id % 12 + 1").count() == 4000


@pytest.mark.parametrize("sort", [(), ("v",)])
def test_only_a_wanted_order_is_sorted_for(spark, table, monkeypatch, sort):
    """Rows that are rebalanced are not sorted again to keep their partitions apart."""
    used = []
    monkeypatch.setattr(versions, "open_writers", lambda s: used.append(s) or session.open_writers(s))
    table.commit(rows(spark, (2023, 1, 2), (2023, 2, 1), (2023, 1, 1)), sort=sort)
    assert bool(used) != bool(sort)
    assert state(table.read()) == [(2023, 1, 1), (2023, 1, 2), (2023, 2, 1)]


def test_batches_that_the_rows_are_in_are_replaced(spark, revised):
    assert revised.replaced(revised.commit(rows(spark, (2023, 3, 7), (2024, 1, 7)), replace_by=PARTITION_KEYS)) == [(2023, 3), (2024, 1)]
    assert state(revised.read()) == [(2022, 12, 1), (2023, 1, 5), (2023, 3, 7), (2024, 1, 7)]
    assert revised.replaced(revised.commit(rows(spark, (2023, 2, 8)), replace_by=("source_year",))) == [(2023, None)]
    assert state(revised.read()) == [(2022, 12, 1), (2023, 2, 8), (2024, 1, 7)]
    with pytest.raises(ValueError, match="source_month"):
        revised.commit(rows(spark, (2023, None, 9)), replace_by=PARTITION_KEYS)
    assert state(revised.read()) == [(2022, 12, 1), (2023, 2, 8), (2024, 1, 7)]


def test_writes_side_by_side_leave_no_setting(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    first, second = session.open_writers(spark), session.open_writers(spark)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == str(session.OPEN_WRITERS)
    second.__exit__(None, None, None)
    assert spark.conf.get(key, None) == before
