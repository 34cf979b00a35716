"""The input tables, from parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapwise.schema import INPUT_COLUMNS


@dataclass(frozen=True)
class Tables:
    """Taps and the reference data that describe them."""

    taps: DataFrame
    participant: DataFrame
    location: DataFrame
    route: DataFrame
    route_type: DataFrame
    coupon_contract: DataFrame
    contract_product: DataFrame
    product: DataFrame
    fare_table: DataFrame
    transfer_time_rules: DataFrame
    transfer_discount_rules: DataFrame


def read_table(spark: SparkSession, where: str) -> DataFrame:
    """A parquet folder if `where` looks like a path, else a catalog table."""
    return spark.read.parquet(where) if "/" in where else spark.table(where)


def wall_clock(instant: Column, zone: str) -> Column:
    """The wall-clock time of an instant in `zone`, whatever the session's zone is."""
    micros = F.unix_micros(F.from_utc_timestamp(instant, zone)).cast("decimal(20,0)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / 1_000_000).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch


def conform(
    frame: DataFrame,
    columns: tuple[str, ...],
    names: Mapping[str, str] | None = None,
    zone: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """Only `columns`, in order. `names` gives the source's name where it differs from ours.

    Values keep their types, but ride starts become wall-clock times without a zone. Where the source
    has instants, `zone` must say in which zone's time they are told. Rows from more than a day before `since`
    (a wall-clock time) may then be left out at the source; an exact filter can't reach it there.
    """
    names = names or {}
    picked = frame.select(*[F.col(names.get(c, c)).alias(c) for c in columns])
    kind = dict(picked.dtypes).get("ride_start_time", "timestamp_ntz")
    if kind == "timestamp":
        if zone is None:
            raise ValueError("ride_start_time holds instants: name the zone whose time they are told in")
        if since is not None:
            day_before = datetime.fromisoformat(since).replace(tzinfo=UTC) - timedelta(days=1)
            micros = int(day_before.timestamp()) * 1_000_000
            picked = picked.where(F.col("ride_start_time") >= F.timestamp_micros(F.lit(micros)))
        picked = picked.withColumn("ride_start_time", wall_clock(F.col("ride_start_time"), zone))
    elif kind != "timestamp_ntz":
        picked = picked.withColumn("ride_start_time", F.col("ride_start_time").cast("timestamp_ntz"))
    return picked


def read_tables(
    spark: SparkSession,
    locations: Mapping[str, str],
    names: Mapping[str, Mapping[str, str]] | None = None,
    zone: str | None = None,
    since: str | None = None,
) -> Tables:
    """Read every input. `locations` maps our table name to a path or catalog table; `names`
    maps it to {our column: source column} for the columns the source calls something else; `zone` and `since`
    are those of `conform`."""
    names = names or {}
    return Tables(
        **{
            table: conform(read_table(spark, locations[table]), columns, names.get(table), zone, since)
            for table, columns in INPUT_COLUMNS.items()
        }
    )


def write_table(frame: DataFrame, where: str) -> None:
    """Store a frame, replacing what is there: a parquet folder if `where` looks like a path, else
    a catalog table. Readers may find nothing meanwhile; `plans.refresh` avoids that."""
    writer = frame.write.mode("overwrite").format("parquet")
    if "/" in where:
        writer.save(where)
    else:
        writer.saveAsTable(where)


def write_buckets(frame: DataFrame, table: str, keys: tuple[str, ...], buckets: int, folder: str | None = None) -> None:
    """Stores a frame as a catalog table of so many buckets by `keys`, one file each, sorted by them.

    Tables with as many buckets by keys of the same kinds are joined on these without a shuffle of either. Files go
    under `folder`, which must be shared storage, or else to the warehouse. Replaces what is there.
    """
    placed = frame.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if folder is not None:
        writer = writer.option("path", f"{folder.rstrip('/')}/{table.rpartition('.')[2]}")
    writer.saveAsTable(table)
