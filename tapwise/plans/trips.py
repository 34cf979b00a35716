"""Trips and enriched trips in one pass over the taps.

Both pair tag-offs with tag-ons, which as joins would read and shuffle the taps once per side and
kind of trip. Here they are shuffled once, to bring a card's taps together, and those of heavy cards
twice. Dropping copies, pairing and transfers all work on the rows so placed.

What a refund takes off is known from its neighbours too, unless tag-ons at its instant charged
different amounts. Then it is a row for each, which a side path makes by a join of its own; where the
taps' statistics say that there are no such refunds, the side path is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.functions.expressions import fare_category_name, tag_off_charge
from tapwise.operators.enrich import TRANSFER_CONTEXT, describe_trips, join_transfers
from tapwise.operators.linking import (
    SLICE_ROWS,
    Slices,
    bring_together,
    latest_tag_on,
    name_first_tap,
    place_rides,
    within_allowance,
)
from tapwise.operators.lookups import MAX_BROADCAST_BYTES, Lookups
from tapwise.operators.pairing import with_fare_period
from tapwise.operators.taps import fare_tx_subset, with_look_back
from tapwise.schema import OUTPUT_COLUMNS, TAP_COLUMNS, TRIP_COLUMNS
from tapwise.sources.statistics import TapStatistics
from tapwise.sources.tables import Tables, write_buckets

_RIDE = ("card_id", "ride_start_time")


def known_taps(subset: DataFrame) -> DataFrame:
    """Tag-ons and tag-offs of a subset. Adds `side`: 0 for a tag-on, 1 for a tag-off.

    The rider category's name follows from its code, so it is left out until the end.
    """
    code = F.col("fare_transaction_sub_type")
    return (
        subset.select(*TAP_COLUMNS)
        .where(code.isin(*V.TAG_ON_CODES, *V.TAG_OFF_CODES))
        .withColumn("side", code.isin(*V.TAG_OFF_CODES).cast("int"))
    )


def _finish(trips: DataFrame, *more: str) -> DataFrame:
    trips = trips.withColumn("fare_category_name", fare_category_name(F.col("fare_category")))
    return with_fare_period(trips).select(*TRIP_COLUMNS, *more)


def partners(ride: WindowSpec) -> dict[str, Column]:
    """What a tap must know of its partners. `ride` orders the taps of an instant by side: a
    tag-off sees the tag-ons one back, a tag-on the tag-offs one ahead. No more than five numbers
    are kept of them, however many they are.
    """
    back, ahead = ride.rangeBetween(-1, -1), ride.rangeBetween(1, 1)
    return {
        "_ons_before": F.count(F.lit(1)).over(back),
        "_amounts_before": F.count("purse_amount").over(back),
        "_least_before": F.min("purse_amount").over(back),
        "_most_before": F.max("purse_amount").over(back),
        "_off_after": F.max("side").over(ahead),
    }


def pair_taps(taps: DataFrame, mixed: DataFrame | None) -> DataFrame:
    """Trips from distinct taps that carry the columns of `partners`.

    Adds fare_charged, trip_type and `has_tag_on`. A refund yields a row per distinct amount that
    its instant's tag-ons charged: one here if they all charged the same, else the rows of `mixed`
    (see `mixed_refunds`). If that is None, finding such a refund ends the job.
    """
    known, is_on = F.col("card_id").isNotNull(), F.col("side") == 0
    paired_on = known & is_on & F.col("_off_after").isNotNull()
    paired_off = known & ~is_on & (F.col("_ons_before") > 0)
    sub_type, amount = F.col("fare_transaction_sub_type"), F.col("purse_amount")
    refund = paired_off & (sub_type == V.REFUND_CODE)
    same = (F.col("_amounts_before") == 0) | (
        (F.col("_amounts_before") == F.col("_ons_before")) & (F.col("_least_before") == F.col("_most_before"))
    )
    same = same | amount.isNull()
    settled = F.col("_most_before") - amount
    if mixed is None:
        wrong = F.raise_error(F.lit("refunds of different amounts, which the statistics don't know: refresh them"))
        settled = F.when(same, settled).otherwise(wrong.cast("bigint"))
        taps = taps.where(~paired_on)
    else:
        taps = taps.where(~paired_on & (~refund | same))
    trips = taps.withColumns(
        {
            "has_tag_on": is_on | paired_off,
            "trip_type": F.when(is_on, F.lit(V.TAG_ON_ONLY))
            .when(paired_off, F.lit(V.TAG_ON_AND_OFF))
            .otherwise(F.lit(V.TAG_OFF_ONLY)),
            "fare_charged": F.when(is_on, amount).when(refund, settled).otherwise(tag_off_charge(sub_type, amount)),
        }
    )
    return trips if mixed is None else trips.unionByName(mixed.select(*trips.columns))


def mixed_refunds(taps: DataFrame, looked: DataFrame) -> DataFrame:
    """The rows of refunds whose tag-ons charged different amounts. `looked` is the taps with the columns of
    `partners`, from which these refunds are taken; they are joined with the different amounts of their instants,
    by a shuffle join that is split where an instant has very many."""
    differ = (F.col("_least_before") < F.col("_most_before")) | F.col("_amounts_before").between(
        F.lit(1), F.col("_ons_before") - 1
    )
    refunds = looked.where("card_id IS NOT NULL AND purse_amount IS NOT NULL").where(
        (F.col("fare_transaction_sub_type") == V.REFUND_CODE) & differ
    )
    amounts = taps.where("side = 0 AND card_id IS NOT NULL").select(*_RIDE, F.col("purse_amount").alias("_on_amount"))
    return (
        refunds.join(amounts.distinct(), [*_RIDE])
        .withColumn("fare_charged", F.col("_on_amount") - F.col("purse_amount"))
        .withColumns({"has_tag_on": F.lit(True), "trip_type": F.lit(V.TAG_ON_AND_OFF)})
    )


def _paired(taps: DataFrame, looked: DataFrame, statistics: TapStatistics | None) -> DataFrame:
    if statistics is not None and not statistics.mixed_refunds:
        return pair_taps(looked, None)
    return pair_taps(looked, mixed_refunds(taps, looked))


def trips(
    subset: DataFrame, slice_rows: int = SLICE_ROWS, statistics: TapStatistics | None = None
) -> DataFrame:
    """All trips of a subset of taps. `statistics` are those of the table that the taps are of."""
    taps = known_taps(subset)
    slices = Slices.measure(taps, slice_rows, MAX_BROADCAST_BYTES, statistics)
    ride = Window.partitionBy(*_RIDE).orderBy("side")
    looked = place_rides(taps, slices, lambda placed: placed.withColumns(partners(ride)))
    return _finish(_paired(taps, looked, statistics))


def trips_with_context(
    subset: DataFrame,
    tables: Tables,
    lookups: Lookups | None = None,
    slice_rows: int = SLICE_ROWS,
    statistics: TapStatistics | None = None,
    since: str | None = None,
) -> DataFrame:
    """All trips, each with the transfer that led to it. With `since`, those that start at or after it; what
    `subset` holds before it are first taps of transfers only."""
    lookups = lookups or Lookups(tables)
    taps = known_taps(subset)
    slices = Slices.of(taps, lookups, slice_rows, statistics)
    card = Window.partitionBy("card_id", "slice").orderBy("moment")

    def look(together: DataFrame) -> DataFrame:
        return together.withColumns({"latest": latest_tag_on(card), **partners(card)})

    linked = bring_together(taps, lookups, slices, look, *TAP_COLUMNS)
    if since is not None:
        linked = linked.where(F.col("ride_start_time") >= F.lit(since).cast("timestamp_ntz"))
    paired = _paired(taps, linked, statistics).withColumn("first", F.when(F.col("has_tag_on"), within_allowance()))
    named = name_first_tap(paired, lookups).withColumns(
        {name: F.col(source) for name, source in TRANSFER_CONTEXT.items()}
    )
    return _finish(named, *TRANSFER_CONTEXT)


def enriched_trips(
    tables: Tables,
    since: str = V.SINCE,
    lookups: Lookups | None = None,
    slice_rows: int = SLICE_ROWS,
    statistics: TapStatistics | None = None,
    look_back: bool = False,
) -> DataFrame:
    """The wide trip table of the newest period, straight from its taps.

    With `look_back`, transfers that begin before the period are found too: the tag-ons of the longest
    allowance before `since` are read besides.
    """
    lookups = lookups or Lookups(tables)
    if look_back:
        subset = with_look_back(tables.taps, since, lookups.longest_allowance())
    else:
        subset = fare_tx_subset(tables.taps, since)
    linked = trips_with_context(subset, tables, lookups, slice_rows, statistics, since if look_back else None)
    return describe_trips(linked, lookups).select(*OUTPUT_COLUMNS)


def enrich(
    trips: DataFrame, transfers: DataFrame, tables: Tables, lookups: Lookups | None = None
) -> DataFrame:
    """The same table from stored trips and transfers."""
    lookups = lookups or Lookups(tables)
    return describe_trips(join_transfers(trips, transfers), lookups).select(*OUTPUT_COLUMNS)


def store_for_enrich(
    trips: DataFrame, transfers: DataFrame, names: tuple[str, str], buckets: int, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Trips and transfers stored so that `enrich` joins them without shuffling either, and read back.

    Both are in buckets by card and the instant at which they meet, so a heavy card is in many.
    """
    write_buckets(trips, names[0], _RIDE, buckets, folder)
    write_buckets(transfers, names[1], ("card_id", "trip_2_tag_on_time"), buckets, folder)
    spark = trips.sparkSession
    return spark.table(names[0]), spark.table(names[1])
