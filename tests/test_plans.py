"""What plans look like: what reaches the files, what is shuffled, what is broadcast."""

import re

import pytest
from worlds import make_tables, random_world

from pyspark.sql import functions as F

import __spark_entry__ as registered
from tapwise.operators import taps
from tapwise.operators.enrich import join_transfers
from tapwise.operators.linking import heavy_cards
from tapwise.operators.lookups import Lookups, measured_bytes
from tapwise.operators.transfers import transfers
from tapwise.plans import trips
from tapwise.schema import TAP_COLUMNS
from tapwise.sources.sample import sample_lookups, sample_statistics, sample_tables
from tapwise.sources.statistics import TapStatistics
from tapwise.sources.tables import Tables, conform, read_tables, write_table


def plan_of(frame, capsys) -> str:
    frame.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory) -> Tables:
    """Tables read back from files, under foreign column names for the taps."""
    root = str(tmp_path_factory.mktemp("stored"))
    tables = make_tables(spark, **random_world(1))
    foreign = {"card_id": "serial", "ride_start_time": "start_pst"}
    for name, frame in vars(tables).items():
        if name == "taps":
            frame = frame.withColumnsRenamed(foreign).selectExpr("'x' AS unused", "*")
        write_table(frame, f"{root}/{name}")
    return read_tables(spark, {n: f"{root}/{n}" for n in vars(tables)}, {"taps": foreign})


def test_filters_and_columns_reach_the_files(stored, capsys):
    plan = plan_of(taps.tag_ons(taps.fare_tx_subset(stored.taps)), capsys)
    assert "GreaterThanOrEqual(start_pst,2024-01-02T00:00)" in plan
    assert "In(fare_transaction_sub_type, [1,2,4])" in plan
    assert "unused" not in plan


def test_read_tables_keeps_rows(spark, stored):
    made = make_tables(spark, **random_world(1))
    for name, frame in vars(stored).items():
        assert frame.exceptAll(getattr(made, name)).isEmpty(), name


def test_zoned_times_do_not_depend_on_the_session(spark, tmp_path, capsys):
    """Instants around both changes of the clocks, read under two session zones."""
    micros = [int(t) * 1_000_000 for t in (1704182400, 1704182399, 1710064799, 1710064800, 1730620800, 1730624400)]
    instants = spark.createDataFrame([(m,) for m in micros], "m long").select(
        *[F.lit(None).cast("int").alias(c) for c in TAP_COLUMNS if c != "ride_start_time"],
        F.timestamp_micros("m").alias("ride_start_time"),
    )
    instants.write.parquet(str(tmp_path / "taps"))
    session, found = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            taps = conform(
                spark.read.parquet(str(tmp_path / "taps")), TAP_COLUMNS, None, "America/Los_Angeles", "2024-01-02 00:00:00"
            )
            late = taps.where(F.col("ride_start_time") >= F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
            assert "PushedFilters: [IsNotNull(ride_start_time), GreaterThanOrEqual(ride_start_time," in plan_of(late, capsys)
            found.append(sorted(str(r.ride_start_time) for r in late.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", session)
    assert found == 3 * [
        ["2024-01-02 00:00:00", "2024-03-10 01:59:59", "2024-03-10 03:00:00", "2024-11-03 01:00:00", "2024-11-03 01:00:00"]
    ]
    with pytest.raises(ValueError, match="name the zone"):
        conform(instants, TAP_COLUMNS)


def test_cards_without_a_number_are_not_heavy(spark):
    taps_of_nobody = make_tables(spark, **random_world(1)).taps.withColumn("card_id", F.lit(None).cast("long"))
    assert heavy_cards(taps_of_nobody, 5).count() == 0


@pytest.mark.parametrize("heavy", [False, True])
def test_taps_are_shuffled_once_and_those_of_heavy_cards_twice(spark, sf_dir, capsys, heavy):
    tables = sample_tables(spark, sf_dir)
    subset = taps.fare_tx_subset(tables.taps)
    counted = sample_statistics(tables)
    slice_rows = sorted(r.taps for r in counted.frame.collect())[-3] if heavy else counted.largest
    statistics = TapStatistics(counted.frame, counted.largest, 0)
    linked = trips.trips_with_context(subset, tables, sample_lookups(spark), slice_rows, statistics)
    for frame in (trips.trips(subset, slice_rows, statistics), linked):
        frame.explain()
        plan = capsys.readouterr().out
        exchanges = [e for e in re.findall(r"Exchange hashpartitioning\((.*)", plan) if "card_id#" in e]
        # By card or ride: one for ordinary cards; heavy ones have another, by whole rows.
        assert len(exchanges) == (3 if heavy else 1)
        assert sum(e.count("#") > 10 for e in exchanges) == (1 if heavy else 0)
        assert len(re.findall(r"Sort \[card_id#", plan)) == (2 if heavy else 1)
        assert "SortMergeJoin" not in plan and "collect_set" not in plan


@pytest.mark.parametrize("name", registered._QUERIES | registered._ODD_QUERIES)
def test_no_pairs_and_no_python(spark, sf_dir, name, capsys):
    plan = plan_of(registered.queries()[name](spark, sf_dir), capsys)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InArrow", "InPandas", "CollectLimit", "collect_set"):
        assert bad not in plan


def test_broadcast_only_what_is_small(spark, capsys):
    tables = make_tables(spark, **random_world(2))
    small, big = Lookups(tables), Lookups(tables, max_broadcast_bytes=100)
    assert all(small[n].small for n in ("service", "fare", "location"))
    assert not any(big[n].small for n in ("service", "fare", "location"))


def test_lookups_share_one_budget(spark):
    tables = make_tables(spark, **random_world(2))
    names = ("coupon", "location", "fare")
    sizes = measured_bytes({n: Lookups(tables, names)[n].frame for n in names})
    least, middle, most = sorted(names, key=sizes.get)
    assert 0 < sizes[least] <= sizes[middle] < sizes[most]
    two = Lookups(tables, names, sizes[least] + sizes[middle], keep=True)
    assert [two[n].small for n in (least, middle, most)] == [True, True, False]
    assert two.bytes_left == 0
    assert Lookups(tables, names, sizes[least])[middle].small is False
    two.release()


def test_only_what_is_broadcast_is_kept(spark):
    tables = make_tables(spark, **random_world(2))
    names = ("coupon", "service", "unlisted_service")
    sizes = measured_bytes({n: Lookups(tables, names)[n].frame for n in names})
    kept = Lookups(tables, names, sizes["coupon"], keep=True)
    assert kept["coupon"].small and not kept["service"].small
    assert len(kept._held) == 1
    want = sorted(map(repr, Lookups(tables, names)["service"].frame.collect()))
    assert sorted(map(repr, kept["service"].frame.collect())) == want
    kept.release()


def test_plans_with_statistics_start_no_job(spark, sf_dir):
    tables, lookups = sample_tables(spark, sf_dir), sample_lookups(spark)
    statistics = sample_statistics(tables)
    spark.sparkContext.setJobGroup("planning", "")
    try:
        ons = taps.tag_ons(taps.fare_tx_subset(tables.taps))
        transfers(ons, tables, lookups, statistics=statistics)
        trips.enriched_trips(tables, lookups=lookups, statistics=statistics)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stored_trips_and_transfers_are_joined_where_they_are(spark, sf_dir, capsys):
    tables = sample_tables(spark, sf_dir)
    found = registered._transfers(tables)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = trips.store_for_enrich(registered._trips(tables), found, ("bucketed_trips", "bucketed_transfers"), 4)
        plan = plan_of(join_transfers(*stored), capsys)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in plan_of(join_transfers(registered._trips(tables), found), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("bucketed_trips", "bucketed_transfers"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
