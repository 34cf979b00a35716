"""Pairing tag-offs with the tag-ons of the same card and ride start."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.functions.expressions import fare_month, fare_year, tag_off_charge
from tapwise.schema import CHARGED_COLUMNS, TRIP_COLUMNS

RIDE = ["card_id", "ride_start_time"]


def complete_trips(offs: DataFrame, ons: DataFrame) -> DataFrame:
    """One row per matching pair: the tag-off's columns and what the ride cost."""
    on_amounts = ons.select(*RIDE, F.col("purse_amount").alias("on_amount"))
    return (
        offs.join(on_amounts, RIDE)
        .withColumn(
            "fare_charged",
            tag_off_charge(
                F.col("fare_transaction_sub_type"), F.col("purse_amount"), F.col("on_amount")
            ),
        )
        .select(*CHARGED_COLUMNS)
    )


def tagoff_only_trips(offs: DataFrame, ons: DataFrame) -> DataFrame:
    """Tag-offs without a tag-on; a card that is NULL never has one."""
    return _without_partner(offs, ons).withColumn(
        "fare_charged",
        tag_off_charge(F.col("fare_transaction_sub_type"), F.col("purse_amount")),
    )


def tagon_only_trips(ons: DataFrame, offs: DataFrame) -> DataFrame:
    """Tag-ons without a tag-off."""
    return _without_partner(ons, offs).withColumn("fare_charged", F.col("purse_amount"))


def _without_partner(taps: DataFrame, others: DataFrame) -> DataFrame:
    # The distinct is combined map-side and shuffled by the join's own keys: it costs no
    # exchange of its own, and a ride start repeated many times shuffles once per task.
    return taps.join(others.select(*RIDE).distinct(), RIDE, "left_anti").select(*taps.columns)


def union_trips(complete: DataFrame, off_only: DataFrame, on_only: DataFrame) -> DataFrame:
    """The three kinds of trip as one set of rows, with the fare period they fall in."""

    def kind(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*CHARGED_COLUMNS, F.lit(name).alias("trip_type"))

    return with_fare_period(
        kind(off_only, V.TAG_OFF_ONLY)
        .union(kind(on_only, V.TAG_ON_ONLY))
        .union(kind(complete, V.TAG_ON_AND_OFF))
        .distinct()
    ).select(*TRIP_COLUMNS)


def with_fare_period(trips: DataFrame) -> DataFrame:
    time = F.col("ride_start_time")
    return trips.withColumns({"fare_year": fare_year(time), "fare_month": fare_month(time)})
