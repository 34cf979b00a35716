"""What is known of a stored tap table before any plan reads it: a small table kept beside it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.operators.taps import card_layout
from tapwise.sources.tables import read_table, write_table

COLUMNS = ("card_id", "taps", "mixed_refunds")


@dataclass(frozen=True)
class TapStatistics:
    """Taps per card of a whole table. Plans over any part of that table may use it: a part has no more."""

    frame: DataFrame
    # Taps of the biggest card, and refunds whose tag-ons charged different amounts.
    largest: int
    mixed_refunds: int

    def cards_above(self, taps: int) -> DataFrame:
        """Cards with more than so many taps, and how many; the file's statistics leave out the rest."""
        return self.frame.where(F.col("taps") > taps).select("card_id", "taps")


def count_taps(taps: DataFrame) -> DataFrame:
    """COLUMNS per card, the biggest first, in one pass: by ride, and of that by card.

    `mixed_refunds` are rides with a refund whose tag-ons charged different amounts. Taps without a
    card pair with nothing and are not counted.
    """
    code, amount = F.col("fare_transaction_sub_type"), F.col("purse_amount")
    charged = F.when(code.isin(*V.TAG_ON_CODES), amount)
    silent = code.isin(*V.TAG_ON_CODES) & amount.isNull()
    rides = (
        taps.where("card_id IS NOT NULL")
        .groupBy("card_id", "ride_start_time")
        .agg(
            F.count(F.lit(1)).alias("taps"),
            F.max(code == V.REFUND_CODE).alias("refund"),
            F.min(charged).alias("least"),
            F.max(charged).alias("most"),
            F.max(silent).alias("silent"),
        )
    )
    differ = (F.col("least") < F.col("most")) | (F.col("silent") & F.col("most").isNotNull())
    mixed = F.coalesce(F.col("refund") & differ, F.lit(False)).cast("bigint")
    return (
        rides.groupBy("card_id")
        .agg(F.sum("taps").alias("taps"), F.sum(mixed).alias("mixed_refunds"))
        .select(*COLUMNS)
    )


def summed_up(counted: DataFrame) -> TapStatistics:
    """Reads two numbers of the table of `count_taps`."""
    top = counted.agg(F.max("taps").alias("largest"), F.sum("mixed_refunds").alias("mixed")).first()
    return TapStatistics(counted, top.largest or 0, top.mixed or 0)


def beside(where: str) -> str:
    """The place of a tap table's statistics."""
    return f"{where.rstrip('/')}__statistics"


def write_statistics(spark: SparkSession, where: str) -> TapStatistics:
    """Counts the taps stored at `where`, and keeps the counts beside them. To be run again whenever they
    change; until then plans stay right but may find cards heavy, or not, that were so before."""
    counted = count_taps(read_table(spark, where)).repartitionByRange(F.desc("taps"))
    write_table(counted.sortWithinPartitions(F.desc("taps")), beside(where))
    return read_statistics(spark, where)


def read_statistics(spark: SparkSession, where: str) -> TapStatistics:
    return summed_up(read_table(spark, beside(where)))


def write_taps(taps: DataFrame, where: str) -> TapStatistics:
    """Stores taps placed by card and sorted by time, and their statistics with them."""
    write_table(card_layout(taps), where)
    return write_statistics(taps.sparkSession, where)
