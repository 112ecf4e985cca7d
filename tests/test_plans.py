"""Shapes of physical plans, and totals that must agree between models."""

from __future__ import annotations

import pytest

from tests.rows import trips
from tierwise.operators import gold
from tierwise.operators.bronze import audit_trips
from tierwise.operators.dimension import trips_with_zones
from tierwise.operators.silver import silver_trips, stage_trips
from tierwise.plans import layers, registry, stored
from tierwise.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_scan_prunes_partitions(spark):
    text = plan(registry.queries()["scan_month"](spark, SF))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "source_year" in filters and "source_month" in filters


def test_gold_reads_only_its_columns(spark):
    staged = stage_trips(stored.silver_table(spark, SF).read())
    text = plan(gold.TRIP_MODELS["hourly_summary"].build(staged))
    schema = text.split("ReadSchema: ")[1]
    assert "fare_amount" in schema and "store_and_fwd_flag" not in schema
    assert text.count("Exchange") == 1


def test_zone_joins_are_broadcast_only_while_small(spark):
    staged, zones = layers.staged_trips(spark, SF), tables.zones(spark, SF)
    keys = ["pickup_zone", "dropoff_zone"]
    small = sorted(map(str, trips_with_zones(staged, zones).groupBy(*keys).count().collect()))
    assert plan(trips_with_zones(staged, zones)).count("BroadcastHashJoin [") >= 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = trips_with_zones(staged, zones)
        assert "BroadcastHashJoin [pickup" not in plan(shuffled)
        assert sorted(map(str, shuffled.groupBy(*keys).count().collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n.startswith(("silver", "gold", "dash", "stg", "dq_not"))])
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for word in ("Python", "ArrowEval", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert word not in text


def test_models_agree_on_totals(spark):
    zoned = layers.zoned_trips(spark, SF)
    totals = {
        name: model.build(zoned).agg({"total_trips": "sum"}).first()[0]
        for name, model in gold.TRIP_MODELS.items()
    }
    assert len(set(totals.values())) == 1


def test_one_pass_equals_single_models(spark):
    zoned = layers.zoned_trips(spark, SF)
    combined = gold.trip_models_in_one_pass(zoned)
    for name, model in gold.TRIP_MODELS.items():
        single = model.build(zoned)
        picked = gold.pick_trip_model(combined, name)
        assert set(picked.columns) == set(single.columns)
        columns = sorted(single.columns)
        assert sorted(map(str, picked.select(columns).collect())) == sorted(
            map(str, single.select(columns).collect())
        )


def summary(spark, *changes):
    silver = stage_trips(silver_trips(audit_trips(trips(spark, *changes))))
    return gold.TRIP_MODELS["daily_summary"].build(silver).collect()


def hour(h):
    import datetime

    start = datetime.datetime(2023, 1, 15, h, 0)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + datetime.timedelta(minutes=30)}


def test_no_distance_gives_no_ratio(spark):
    (row,) = summary(spark, {"trip_distance": 0.0})
    assert row.revenue_per_mile is None and row.revenue_per_minute == 0.67


def test_peak_hours(spark):
    # Lower median of an even number of trips; the earliest of the modes.
    (row,) = summary(spark, *[hour(h) for h in (3, 3, 9, 9)])
    assert (row.peak_pickup_hour, row.modal_pickup_hour) == (3, 3)
    (row,) = summary(spark, *[hour(h) for h in (0, 23, 23)])
    assert (row.peak_pickup_hour, row.modal_pickup_hour) == (23, 23)
    (row,) = summary(spark, hour(0))
    assert (row.peak_pickup_hour, row.modal_pickup_hour) == (0, 0)


def test_no_line_is_sorted_for_the_join_with_orders(spark):
    text = plan(tables.trips(spark, SF))
    assert "ShuffledHashJoin" in text and "Sort " not in text


def test_a_history_is_made_from_the_stored_batches(spark, monkeypatch):
    """Replacements read their partitions of Bronze; lines and orders are not joined for each."""
    stored.bronze_table(spark, SF)
    key = (spark.sparkContext.applicationId, SF, "revised")
    monkeypatch.delitem(stored._made, key, raising=False)
    monkeypatch.setattr(tables, "trips", lambda *_: pytest.fail("joined again"))
    assert stored.revised_trips(spark, SF).latest_version() == 4


def test_orders_are_joined_by_what_is_used_of_them(spark):
    """The join holds a key and one digit per order, no text."""
    joined = plan(tables.trips(spark, SF)).split("ShuffledHashJoin")[1].split("Exchange hashpartitioning(o_orderkey")[1]
    assert "AS TINYINT" in joined.upper() or "as tinyint" in joined
