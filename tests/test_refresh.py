"""The batch job."""

import pyarrow.parquet as pq
import pytest
from worlds import make_tables, random_world

from pyspark.sql import functions as F

from tapwise.plans import publish, refresh, trips
from tapwise.schema import OUTPUT_COLUMNS


def versions(spark, name):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]


def test_refresh(spark):
    tables = make_tables(spark, **random_world(1))
    table = trips.enriched_trips(tables)
    history = {"low": table.where("fare_charged < 100"), "high": table.where("fare_charged >= 50")}
    want = sorted(map(repr, table.distinct().collect()))
    for run in range(3):
        published = refresh.refresh(tables, history, "all_trips")
        assert published.columns == list(OUTPUT_COLUMNS)
        assert sorted(map(repr, published.collect())) == want
        assert set(publish.members(spark, "all_trips")) == {"low", "high", "newest"}
        assert len(versions(spark, "all_trips__newest")) == min(run + 1, 2)
        assert len(versions(spark, "all_trips__low")) == len(versions(spark, "all_trips__high")) == 1
    with pytest.raises(ValueError, match="period to rebuild"):
        refresh.refresh(tables, history, "all_trips", period="low")
    publish.drop_publication(spark, "all_trips")
    assert not versions(spark, "all_trips__newest") + versions(spark, "all_trips__low")
    assert not spark.catalog.tableExists("all_trips")


def test_earlier_periods_are_neither_read_nor_written(spark, tmp_path, monkeypatch):
    tables = make_tables(spark, **random_world(1))
    table = trips.enriched_trips(tables)
    history = {"old": table.where("ride_start_time < '2024-06-01'"), "odd": table.where("card_id IS NULL")}
    refresh.refresh(tables, history, "slow_trips", folder=str(tmp_path))

    def state():
        kept = [p for p in tmp_path.rglob("*") if p.is_file() and "__newest__" not in str(p)]
        return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in kept}

    before, newest = state(), {str(p) for p in tmp_path.glob("*__newest__*")}
    assert before and newest
    # Not to be read: any use of these would fail.
    broken = dict.fromkeys(history, spark.range(1).select(F.raise_error(F.lit("read"))))
    refresh.refresh(tables, broken, "slow_trips", folder=str(tmp_path))
    assert state() == before
    assert {str(p) for p in tmp_path.glob("*__newest__*")} > newest
    assert sorted(map(repr, spark.table("slow_trips").collect())) == sorted(map(repr, table.distinct().collect()))
    publish.drop_publication(spark, "slow_trips")
    assert not list(tmp_path.iterdir())


def test_failed_refresh_changes_nothing(spark, tmp_path):
    good = make_tables(spark, **random_world(1))
    before = refresh.refresh(good, {}, "stable_trips", folder=str(tmp_path)).count()
    world = random_world(1)
    bad = make_tables(spark, **{**world, "transfer_time_rules": [("Ferry", "soon")]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        refresh.refresh(bad, {}, "stable_trips", folder=str(tmp_path))
    assert spark.table("stable_trips").count() == before
    assert len(versions(spark, "stable_trips")) == 1
    assert [p.name for p in tmp_path.iterdir()] == versions(spark, "stable_trips")


def test_refresh_drops_only_its_own_old_versions(spark, tmp_path):
    tables = make_tables(spark, **random_world(2))
    others = ["fares__archive", "fares__newest", "fares__10_old", "fares__newest__20240101000000000000_0123abcd"]
    for name in others:
        spark.range(3).write.saveAsTable(name)
    nested = refresh.refresh(tables, {}, "fares__newest__b", folder=str(tmp_path)).count()
    for run in range(3):
        published = refresh.refresh(tables, {}, "fares", folder=str(tmp_path))
        assert published.count() == nested
        kept = [t for t in versions(spark, "fares") if t not in others and not t.startswith("fares__newest__b")]
        assert len(kept) == min(run + 1, 2)
        files = {p.name for p in tmp_path.iterdir() if not p.name.startswith("fares__newest__b")}
        assert files == set(kept)
    assert all(spark.table(name).count() == 3 for name in others)
    assert spark.table("fares__newest__b").count() == nested
    with pytest.raises(ValueError, match="period's name"):
        publish.publish_period(published, "fares", "a__b")


def test_published_files_are_placed_by_card(spark, tmp_path):
    tables = make_tables(spark, **random_world(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh.refresh(tables, {}, "placed_trips", folder=str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in tmp_path.glob("*/*.parquet"):
        column = pq.read_table(file, columns=["card_id"]).column(0).drop_null().to_pylist()
        assert column == sorted(column)
        if column:
            spans.append((column[0], column[-1]))
    spans.sort()
    assert len(spans) > 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
