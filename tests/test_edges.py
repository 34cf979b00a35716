"""One hand-made case per rule."""

from datetime import datetime, timedelta

import pytest
from worlds import NOON, make_tables, tap

from oracle import LABEL_ROWS
from tapwise.operators import enrich as E
from tapwise.operators import pairing, taps
from tapwise.operators.lookups import Lookups, services
from tapwise.operators.periods import all_period_trips
from tapwise.operators.transfers import transfers
from tapwise.plans import trips
from tapwise.schema import OUTPUT_COLUMNS

FERRY = dict(
    participant=[(1, "Ferry"), (2, "Rail")],
    transfer_time_rules=[("Ferry", "60")],
)

pytestmark = pytest.mark.usefixtures("tiny")


def found_transfers(spark, rows, **tables):
    t = make_tables(spark, taps=rows, **{**FERRY, **tables})
    return [r.asDict() for r in transfers(taps.tag_ons(taps.fare_tx_subset(t.taps)), t).collect()]


def test_cutoff_is_inclusive(spark):
    start = datetime(2024, 1, 2)
    rows = [
        tap(at=start - timedelta(microseconds=1), card=1),
        tap(at=start, card=2),
        (3, None, *tap()[2:]),
    ]
    subset = taps.fare_tx_subset(make_tables(spark, taps=rows).taps)
    assert [r.card_id for r in subset.collect()] == [2]


def test_fare_categories(spark):
    rows = [tap(fare_category=c) for c in (0, 1, 2, 3, 4, None)]
    subset = taps.fare_tx_subset(make_tables(spark, taps=rows).taps)
    names = {r.fare_category: r.fare_category_name for r in subset.collect()}
    assert names == {
        0: "Adult", 1: "Senior", 2: "RTC", 3: "Youth", 4: "Undefined", None: "Undefined",
    }


def test_sides(spark):
    rows = [tap(sub_type=c) for c in (0, 1, 2, 3, 4, 5, 6, None)]
    subset = taps.fare_tx_subset(make_tables(spark, taps=rows).taps)
    code = "fare_transaction_sub_type"
    assert sorted(r[code] for r in taps.tag_ons(subset).collect()) == [1, 2, 4]
    assert sorted(r[code] for r in taps.tag_offs(subset).collect()) == [3, 5]


def test_several_amounts_at_one_instant(spark):
    rows = [
        tap(purse_amount=500),
        tap(purse_amount=500, operator_id=2),
        tap(purse_amount=None),
        tap(purse_amount=700),
        tap(sub_type=3, purse_amount=100),
        tap(sub_type=3, purse_amount=None),
        tap(sub_type=5, purse_amount=90),
    ]
    subset = taps.fare_tx_subset(make_tables(spark, taps=rows).taps)
    charges = [(r.purse_amount, r.fare_charged) for r in trips.trips(subset).collect()]
    key = lambda pair: [-1 if x is None else x for x in pair]
    assert sorted(charges, key=key) == sorted(
        [(100, 400), (100, 600), (100, None), (None, None), (90, 90)], key=key
    )
    offs, ons = taps.tag_offs(subset), taps.tag_ons(subset)
    assert pairing.complete_trips(offs, ons).count() == 12


def test_half_years(spark):
    rows = [tap(at=datetime(2024, 6, 30, 23, 59)), tap(at=datetime(2024, 7, 1))]
    found = trips.trips(taps.fare_tx_subset(make_tables(spark, taps=rows).taps))
    assert sorted((r.fare_year, r.fare_month) for r in found.collect()) == [(2024, 1), (2024, 7)]


@pytest.mark.parametrize(
    ("gap", "transferred"),
    [
        (timedelta(0), False),
        (timedelta(microseconds=1), True),
        (timedelta(minutes=60) - timedelta(microseconds=1), True),
        (timedelta(minutes=60), False),
    ],
)
def test_limits_are_strict(spark, gap, transferred):
    # The hour spans the start of summer time.
    start = NOON + timedelta(minutes=60)
    found = found_transfers(spark, [tap(at=start), tap(at=start + gap, operator_id=2)])
    assert len(found) == transferred
    if found:
        assert found[0]["trip_2_tag_on_time"] - found[0]["trip_1_tag_on_time"] == gap


def test_any_tag_on_is_the_next_tap(spark):
    # The second tap starts nothing, but it ends the first one's wait.
    rows = [tap(at=0), tap(at=10, operator_id=2), tap(at=20), tap(at=15, sub_type=3)]
    found = found_transfers(spark, rows)
    assert [(m["trip_1_tag_on_time"], m["trip_2_tag_on_time"]) for m in found] == [
        (NOON, NOON + timedelta(minutes=10))
    ]


def test_tie_at_the_first_tap(spark):
    # Of two taps at one instant, the one whose allowance reaches is taken; the other is not lost.
    rules = [("Ferry", "60"), ("Rail", "5")]
    rows = [tap(at=0), tap(at=0, operator_id=2), tap(at=30)]
    found = found_transfers(spark, rows, transfer_time_rules=rules)
    assert [m["trip_1_operator"] for m in found] == ["Ferry"]


def test_no_card_no_transfer(spark):
    assert not found_transfers(spark, [tap(card=None), tap(card=None, at=5)])


def test_transfers_across_slices(spark):
    rows = [tap(at=10 * i) for i in range(40)] + [tap(card=2), tap(card=2, at=59)]
    t = make_tables(spark, taps=rows, **FERRY)
    ons = taps.tag_ons(taps.fare_tx_subset(t.taps))
    whole = transfers(ons, t).collect()
    assert len(whole) == 40
    for slice_rows in (1, 3, 39):
        assert sorted(transfers(ons, t, slice_rows=slice_rows).collect()) == sorted(whole)


def test_bad_allowance_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        found_transfers(spark, [tap(), tap(at=5)], transfer_time_rules=[("Ferry", "0.5")])


def test_every_label(spark):
    kinds = [
        (who, f"R{i}", pattern.replace("%", " Anything"), label)
        for i, (who, pattern, label) in enumerate(LABEL_ROWS)
    ]
    kinds += [
        ("East Bay", "other", "A Wheels Local", "East Bay"),
        ("Ferry", "other", "FAST Local", "Ferry"),
    ]
    names = sorted({who for who, *_ in kinds})
    t = make_tables(
        spark,
        participant=list(enumerate(names)),
        route=[(names.index(who), i, route) for i, (who, route, *_) in enumerate(kinds)],
        route_type=[k[:3] for k in kinds],
    )
    found = {(r.participant_name, r.route_type): r.operator_name for r in services(t).collect()}
    for who, _, kind, label in kinds:
        assert found[who, kind] == label


def test_ride_on_no_listed_route(spark):
    # Takes the participant's route type without a route, as does a listed route without a name.
    t = make_tables(
        spark,
        taps=[tap(route_id=7), tap(route_id=8), tap(route_id=None), tap(operator_id=2, route_id=7)],
        participant=[(1, "East Bay"), (2, "Rail")],
        route=[(1, 7, None), (2, 7, "Named")],
        route_type=[("East Bay", None, "Wheels Local"), ("Rail", None, "Loose")],
    )
    found = E.operator_label(t.taps, Lookups(t)).select(
        "operator_id", "route_id", "route_name", "route_type", "operator_name"
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [
            (1, 7, None, "Wheels Local", "Wheels"),
            (1, 8, None, "Wheels Local", "Wheels"),
            (1, None, None, "Wheels Local", "Wheels"),
            (2, 7, None, None, "Rail"),
        ],
        key=repr,
    )


def test_transfer_location(spark):
    t = make_tables(
        spark,
        taps=[tap(at=0), tap(at=5, origin_location=9), tap(card=2, destination_location=9),
              tap(card=2, at=5, origin_location=4)],
        location=[(1, 1, "Pier"), (1, 2, "Dock"), (1, 4, "Quay")],
        **FERRY,
    )
    found = trips.enriched_trips(t).where("transfer_flag = 1").collect()
    assert {r.card_id: r.transfer_location for r in found} == {1: "Dock", 2: "Quay"}
    assert all(r.intraop_transfer_flag == 1 and r.interop_transfer_flag == 0 for r in found)


def test_duplicate_reference_rows_multiply_trips(spark):
    t = make_tables(spark, taps=[tap()], participant=[(1, "Ferry"), (1, "Ferry")], location=[])
    assert trips.enriched_trips(t).count() == 2
    assert trips.enriched_trips(make_tables(spark, taps=[tap()])).count() == 1


def test_periods_match_by_position(spark):
    t = make_tables(spark, taps=[tap(), tap(at=5, purse_amount=1)], **FERRY)
    table = trips.enriched_trips(t)
    renamed = table.toDF(*[f"c{i}" for i in range(25)])
    merged = all_period_trips([table, renamed, table])
    assert merged.columns == list(OUTPUT_COLUMNS)
    assert merged.count() == table.distinct().count() == 2
