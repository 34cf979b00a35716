"""Raw taps: the period subset, its split into tag-ons and tag-offs, and its stored layout."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.functions.expressions import fare_category_name
from tapwise.schema import TAP_COLUMNS


def fare_tx_subset(taps: DataFrame, since: str = V.SINCE) -> DataFrame:
    """Taps from `since` on (inclusive), with the rider category spelled out.

    Scan-only: the time filter and the column list both reach the file reader. Rows are never
    multiplied, whatever the coupon contract table holds.
    """
    return (
        taps.select(*TAP_COLUMNS)
        .where(F.col("ride_start_time") >= F.lit(since).cast("timestamp_ntz"))
        .withColumn("fare_category_name", fare_category_name(F.col("fare_category")))
    )


def with_look_back(taps: DataFrame, since: str, minutes: int) -> DataFrame:
    """As `fare_tx_subset`, and the tag-ons of `minutes` before `since`: those that a transfer over the cutoff
    may have started with."""
    cutoff = F.lit(since).cast("timestamp_ntz")
    earlier = str(datetime.fromisoformat(since) - timedelta(minutes=minutes))
    is_tag_on = F.col("fare_transaction_sub_type").isin(*V.TAG_ON_CODES)
    return fare_tx_subset(taps, earlier).where((F.col("ride_start_time") >= cutoff) | is_tag_on)


def tag_ons(subset: DataFrame, codes: Iterable[int] = V.TAG_ON_CODES) -> DataFrame:
    return subset.where(F.col("fare_transaction_sub_type").isin(*codes))


def tag_offs(subset: DataFrame, codes: Iterable[int] = V.TAG_OFF_CODES) -> DataFrame:
    return subset.where(F.col("fare_transaction_sub_type").isin(*codes))


def card_layout(subset: DataFrame) -> DataFrame:
    """Rows placed by card and sorted by time, for storing.

    Range placement rather than hashing: a card too big for one partition is cut by time, and
    the files get tight min/max statistics on both columns.
    """
    keys = ("card_id", "ride_start_time")
    return subset.repartitionByRange(*keys).sortWithinPartitions(*keys)
