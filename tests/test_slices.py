"""Heavy cards: cut by numbers of taps, whatever their times; statistics; refunds of many amounts."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from worlds import NOON, make_tables, random_world, tap

from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.operators import taps
from tapwise.operators.linking import Slices
from tapwise.operators.lookups import Lookups
from tapwise.operators.transfers import transfers
from tapwise.plans import trips
from tapwise.sources.statistics import count_taps, read_statistics, summed_up, write_statistics, write_taps

RULES = dict(participant=[(1, "Ferry"), (2, "Rail")], transfer_time_rules=[("Ferry", "60"), ("Rail", "1")])
OLD = "1900-01-01 00:00:00"

pytestmark = pytest.mark.usefixtures("tiny")


def times(kind):
    """Microseconds after noon."""
    minute = 60_000_000
    return {
        "burst": [i * 300 * minute for i in range(300)] + [500 * minute + i * 1_000 for i in range(2700)],
        "stray": [i * minute // 5 for i in range(2990)] + [-60 * 365 * 24 * 60 * minute, 90 * 365 * 24 * 60 * minute],
        "one second": [i * minute for i in range(500)] + [700 * minute + i for i in range(2500)],
        "one instant": [i * minute for i in range(500)] + [123 * minute] * 2500,
    }[kind]


@pytest.mark.parametrize("kind", ["burst", "stray", "one second", "one instant"])
def test_no_slice_is_much_too_big(spark, kind):
    bound = 100
    rows = [tap(at=NOON + timedelta(microseconds=t), operator_id=1 + i % 2, purse_amount=i) for i, t in enumerate(times(kind))]
    rows += [tap(card=2, at=i) for i in range(50)] + [tap(card=None, at=0)] * 300
    tables = make_tables(spark, taps=rows, **RULES)
    known = trips.known_taps(taps.fare_tx_subset(tables.taps, OLD))
    lookups = Lookups(tables)
    slices = Slices.of(known, lookups, bound)
    placed = slices.place(slices.heavy(known))
    found = placed.groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("ride_start_time").alias("first"), F.max("ride_start_time").alias("last")
    ).orderBy("slice").collect()
    assert sum(r.n for r in found) == len(times(kind))
    assert len(found) >= len(set(times(kind))) / (2 * bound)
    # An instant is never cut: it may be the last one of a slice.
    one = Counter(times(kind)).most_common(1)[0][1]
    assert all(r.n <= 2 * bound or r.n < bound + one > 2 * bound for r in found)
    assert all(a.last < b.first for a, b in zip(found, found[1:]))
    others = slices.ordinary(known).groupBy("card_id").count().collect()
    assert {tuple(r) for r in others} == {(2, 50), (None, 300)}
    # Equal results, cut or not.
    ons = taps.tag_ons(taps.fare_tx_subset(tables.taps, OLD))
    cut, whole = (Counter(map(tuple, transfers(ons, tables, lookups, n).collect())) for n in (bound, 10**6))
    assert cut == whole and (len(whole) > 10 or kind == "one instant")
    if kind == "burst":
        cut, whole = (Counter(map(tuple, trips.enriched_trips(tables, OLD, lookups, n).collect())) for n in (bound, 10**6))
        assert cut == whole and whole


def test_an_instant_with_very_many_tag_ons(spark, capsys):
    many = 100_000
    one = make_tables(spark, taps=[tap(), tap(sub_type=V.REFUND_CODE, purse_amount=90), tap(sub_type=V.REFUND_CODE, purse_amount=None)])
    ons = spark.range(many).join(one.taps.where("fare_transaction_sub_type <> 3").drop("purse_amount")).select(
        *[c for c in one.taps.columns if c != "purse_amount"], F.col("id").alias("purse_amount")
    )
    rows = ons.unionByName(one.taps.where("fare_transaction_sub_type = 3"))
    found = trips.trips(taps.fare_tx_subset(rows))
    found.explain()
    assert "collect_set" not in capsys.readouterr().out
    sums = found.groupBy("trip_type", "purse_amount").agg(
        F.count(F.lit(1)), F.countDistinct("fare_charged"), F.min("fare_charged"), F.max("fare_charged")
    )
    got = {(r[0], r[1]): tuple(r)[2:] for r in sums.collect()}
    assert got == {
        (V.TAG_ON_AND_OFF, 90): (many, many, -90, many - 91),
        (V.TAG_ON_AND_OFF, None): (1, 0, None, None),
    }


def test_statistics_are_kept_beside_the_taps(spark, tmp_path):
    world = random_world(3)
    tables = make_tables(spark, **world)
    where = str(tmp_path / "taps")
    written = write_taps(tables.taps, where)
    cards = Counter(row[0] for row in world["taps"] if row[0] is not None)
    assert {r.card_id: r.taps for r in written.frame.collect()} == cards
    assert written.largest == max(cards.values())
    assert {r.card_id for r in written.cards_above(5).collect()} == {c for c, n in cards.items() if n > 5}
    again = read_statistics(spark, where)
    assert (again.largest, again.mixed_refunds) == (written.largest, written.mixed_refunds)
    spark.read.parquet(where).where("card_id = 1").write.mode("append").parquet(where)
    assert write_statistics(spark, where).largest >= 2 * cards[1]


def test_statistics_of_nothing(spark):
    found = summed_up(count_taps(make_tables(spark).taps))
    assert (found.largest, found.mixed_refunds) == (0, 0)


def test_results_are_the_same_with_statistics(spark):
    tables = make_tables(spark, **random_world(4))
    lookups, statistics = Lookups(tables), summed_up(count_taps(tables.taps))
    subset = taps.fare_tx_subset(tables.taps)
    plain = trips.trips(subset, 7), trips.enriched_trips(tables, V.SINCE, lookups)
    told = (
        trips.trips(subset, 7, statistics),
        trips.enriched_trips(tables, V.SINCE, lookups, 7, statistics),
    )
    for a, b in zip(plain, told):
        assert Counter(map(repr, a.collect())) == Counter(map(repr, b.collect()))


def test_refunds_unknown_to_the_statistics_end_the_job(spark):
    """Rather than lose a row."""
    rows = [tap(purse_amount=500), tap(purse_amount=700), tap(sub_type=V.REFUND_CODE, purse_amount=100)]
    subset = taps.fare_tx_subset(make_tables(spark, taps=rows).taps)
    stale = summed_up(count_taps(make_tables(spark, taps=[tap()]).taps))
    assert stale.mixed_refunds == 0
    with pytest.raises(Exception, match="refresh them"):
        trips.trips(subset, statistics=stale).collect()
    assert summed_up(count_taps(subset)).mixed_refunds == 1
    assert trips.trips(subset, statistics=summed_up(count_taps(subset))).count() == 2


def test_a_transfer_over_the_cutoff(spark):
    start = datetime.fromisoformat(V.SINCE)
    rows = [
        tap(at=start - timedelta(minutes=20), origin_location=9),
        tap(at=start - timedelta(minutes=20), sub_type=5),
        tap(at=start + timedelta(minutes=30), operator_id=2),
        tap(card=2, at=start - timedelta(minutes=60)),
        tap(card=2, at=start),
        tap(card=3, at=start - timedelta(minutes=10)),
        tap(card=3, at=start - timedelta(minutes=5)),
    ]
    tables = make_tables(spark, taps=rows, **RULES)
    lookups = Lookups(tables)
    assert lookups.longest_allowance() == 60
    ons = taps.tag_ons(taps.with_look_back(tables.taps, V.SINCE, 60))
    for slice_rows in (1, 10**6):
        found = transfers(ons, tables, lookups, slice_rows, since=V.SINCE).collect()
        assert [(r.card_id, r.trip_1_tag_on_time) for r in found] == [(1, start - timedelta(minutes=20))]
        table = trips.enriched_trips(tables, V.SINCE, lookups, slice_rows, look_back=True)
        assert sorted((r.card_id, r.transfer_flag) for r in table.collect()) == [(1, 1), (2, 0)]
    assert transfers(taps.tag_ons(taps.fare_tx_subset(tables.taps)), tables, lookups).count() == 0
    table = trips.enriched_trips(tables, V.SINCE, lookups)
    assert sorted((r.card_id, r.transfer_flag) for r in table.collect()) == [(1, 0), (2, 0)]
