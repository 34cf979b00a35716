"""The engine against the plain account, on worlds full of ties, copies, NULLs and duplicates."""

from collections import Counter

import pytest
from worlds import Account, make_tables, random_world

from tapwise.operators import pairing, taps
from tapwise.operators.lookups import Lookups
from tapwise.operators.transfers import transfers
from tapwise.plans import trips
from tapwise.schema import CHARGED_COLUMNS, TRIP_COLUMNS

pytestmark = pytest.mark.usefixtures("tiny")


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def told(found, columns):
    return Counter(tuple(x[c] for c in columns) for x in found)


@pytest.fixture(params=range(3), scope="module")
def case(request, spark):
    world = random_world(request.param)
    return Account(world), make_tables(spark, **world)


def test_pairing(case):
    account, tables = case
    subset = taps.fare_tx_subset(tables.taps).persist()
    offs, ons = taps.tag_offs(subset), taps.tag_ons(subset)
    complete = pairing.complete_trips(offs, ons)
    off_only = pairing.tagoff_only_trips(offs, ons)
    on_only = pairing.tagon_only_trips(ons, offs)
    assert rows(complete) == told(account.complete(), CHARGED_COLUMNS)
    assert rows(off_only) == told(account.off_only(), CHARGED_COLUMNS)
    assert rows(on_only) == told(account.on_only(), CHARGED_COLUMNS)
    want = told(account.trips(), TRIP_COLUMNS)
    assert rows(pairing.union_trips(complete, off_only, on_only)) == want
    assert rows(trips.trips(subset)) == want
    assert rows(trips.trips(subset, slice_rows=7)) == want


@pytest.mark.parametrize("slice_rows", [1_000_000, 7])
def test_transfers_and_enrichment(case, slice_rows):
    account, tables = case
    lookups = Lookups(tables)
    subset = taps.fare_tx_subset(tables.taps)
    ons = taps.tag_ons(subset)
    found = [r.asDict() for r in transfers(ons, tables, lookups, slice_rows).collect()]
    choices = account.transfer_choices()
    assert len(found) == len(choices) > 0
    for m in found:
        assert (
            m["trip_1_operator"],
            m["trip_2_tag_on_time"],
            m["trip_1_origin_location_name"],
            m["trip_1_destination_location_name"],
            m["allowable_transfer_time"],
        ) in choices[m["card_id"], m["trip_1_tag_on_time"]]
        assert m["transfer_flag"] == 1
    want = account.enriched(found)
    assert rows(trips.enriched_trips(tables, lookups=lookups, slice_rows=slice_rows)) == want
    stored = trips.enrich(
        trips.trips(subset), transfers(ons, tables, lookups, slice_rows), tables, lookups
    )
    assert rows(stored) == want
    lookups.release()


def test_lookups_too_big_to_broadcast(spark):
    world = random_world(7)
    account, tables = Account(world), make_tables(spark, **world)
    ons = taps.tag_ons(taps.fare_tx_subset(tables.taps))
    big = Lookups(tables, max_broadcast_bytes=0)
    found = [r.asDict() for r in transfers(ons, tables, big, 7).collect()]
    assert rows(trips.enriched_trips(tables, lookups=big, slice_rows=7)) == account.enriched(found)
