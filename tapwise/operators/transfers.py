"""Transfers: a tag-on followed by the card's next one within the first operator's allowance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapwise.operators.linking import (
    LINK_LOOKUPS,
    SLICE_ROWS,
    Slices,
    bring_together,
    latest_tag_on,
    name_first_tap,
    within_allowance,
)
from tapwise.operators.lookups import Lookups
from tapwise.schema import TRANSFER_COLUMNS
from tapwise.sources.statistics import TapStatistics
from tapwise.sources.tables import Tables

_COLUMNS = (
    "card_id",
    "ride_start_time",
    "operator_id",
    "route_id",
    "origin_location",
    "destination_location",
)


def transfers(
    ons: DataFrame,
    tables: Tables,
    lookups: Lookups | None = None,
    slice_rows: int = SLICE_ROWS,
    statistics: TapStatistics | None = None,
    since: str | None = None,
) -> DataFrame:
    """One row per transfer. Both taps are tag-ons; the second may be with any operator.

    A tag-on starts at most one transfer and is reached by at most one. Both limits are strict: a
    second tap at the same instant, or exactly at the end of the allowance, is no transfer.

    With `since`, only transfers that end at or after it; `ons` may then hold tag-ons before it, which
    are first taps only (`operators.taps.with_look_back`). `statistics` are those of the table that the taps are of.
    """
    lookups = lookups or Lookups(tables, LINK_LOOKUPS)
    taps = ons.select(*_COLUMNS).where("card_id IS NOT NULL").withColumn("side", F.lit(0))
    slices = Slices.of(taps, lookups, slice_rows, statistics)
    card = Window.partitionBy("card_id", "slice").orderBy("moment")

    def look_back(together: DataFrame) -> DataFrame:
        new = F.lag("moment").over(card)
        return together.withColumns(
            {"latest": latest_tag_on(card), "new_instant": F.coalesce(new != F.col("moment"), F.lit(True))}
        )

    looked_back = bring_together(taps, lookups, slices, look_back, *_COLUMNS)
    if since is not None:
        looked_back = looked_back.where(F.col("ride_start_time") >= F.lit(since).cast("timestamp_ntz"))
    # Taps at one instant have the same transfer; all but the first are dropped where they are.
    second = (
        looked_back.withColumn("first", within_allowance())
        .where(F.col("first").isNotNull() & F.col("new_instant"))
        .select("card_id", "ride_start_time", "first")
    )
    return (
        name_first_tap(second, lookups)
        .withColumn("trip_2_tag_on_time", F.col("ride_start_time"))
        .select(*TRANSFER_COLUMNS)
    )
