"""Reference-data lookups: what they hold, how big they are, and how they are joined.

Lookups are broadcast only once their sizes have been measured: the smallest first, as long as all those
broadcast stay within one bound. The others are left as shuffle joins, where adaptive execution splits the
partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapwise.functions.expressions import operator_label
from tapwise.sources.tables import Tables

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
KEPT_PARTITIONS = 8
# What a row costs in a broadcast hash table beyond its column values.
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    keys: tuple[str, ...]
    small: bool = False
    bytes: int = 0
    # What has been attached before, ready to be joined again: plans ask for the same columns each time.
    _sides: dict[tuple, DataFrame] = field(default_factory=dict, compare=False, repr=False)

    def attach(self, rows: DataFrame, on: Iterable[str | Column], **wanted: str) -> DataFrame:
        """Left join on `on` (one per key); `wanted` maps a new column name to a lookup column.

        The lookup's keys stay in the result under names of their own, for the last select to drop.
        """
        key_names = [f"_{next(iter(wanted))}_key_{i}" for i in range(len(self.keys))]
        asked = tuple(wanted.items())
        if asked not in self._sides:
            side = self.frame.select(
                *[F.col(key).alias(name) for key, name in zip(self.keys, key_names)],
                *[F.col(source).alias(name) for name, source in asked],
            )
            self._sides[asked] = F.broadcast(side) if self.small else side
        side = self._sides[asked]
        matches = [
            (F.col(left) if isinstance(left, str) else left) == F.col(name)
            for left, name in zip(on, key_names, strict=True)
        ]
        return rows.join(side, reduce(Column.__and__, matches), "left")


# Lookup -> its key columns.
KEYS = {
    "service": ("operator_id", "route_id"),
    "unlisted_service": ("operator_id",),
    "start": ("operator_id", "route_id"),
    "unlisted_start": ("operator_id",),
    "location": ("participant_id", "location_code"),
    "one_location": ("participant_id", "location_code"),
    "contract_product": ("contract_type",),
    "coupon": ("id",),
    "fare": (
        "operator",
        "origin_location",
        "destination_location",
        "route_type",
        "fare_year",
        "fare_month",
    ),
    "discount": ("operator_transferred_from", "operator_transferred_to"),
}


class Lookups:
    """The lookups named, measured together in one small job.

    `max_broadcast_bytes` bounds the sum of those that are broadcast. With `keep`, those of them that are
    themselves joins are held in the executors' storage for the jobs to come, until `release`; what is too big to
    broadcast is not. Don't keep them longer than the reference data stay as they are.
    """

    def __init__(
        self,
        tables: Tables,
        names: Iterable[str] = tuple(KEYS),
        max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
        keep: bool = False,
    ):
        self._derived: dict[str, DataFrame] = {}
        self._keep = keep
        names = tuple(names)
        sizes = measured_bytes({name: self._frame(name, tables) for name in names})
        fitting = within_budget(sizes, max_broadcast_bytes)
        # What plans may broadcast besides.
        self.bytes_left = max_broadcast_bytes - sum(sizes[name] for name in fitting)
        for source in {_source(name) for name in names if name not in fitting} & set(self._derived):
            # Other lookups may be made of it too; it is computed for each rather than held.
            self._derived.pop(source).unpersist()
        self._held = list(self._derived.values()) if keep else []
        self._keep = False
        self._by_name = {
            name: Lookup(self._frame(name, tables), KEYS[name], name in fitting) for name in names
        }

    def __getitem__(self, name: str) -> Lookup:
        return self._by_name[name]

    def release(self) -> None:
        for frame in self._held:
            frame.unpersist()

    def longest_allowance(self) -> int:
        """Minutes that the longest transfer may take; 0 without rules."""
        starts = [self[name].frame for name in ("start", "unlisted_start")]
        return max(frame.agg(F.coalesce(F.max("minutes"), F.lit(0))).first()[0] for frame in starts)

    def _frame(self, name: str, tables: Tables) -> DataFrame:
        match name:
            case "service" | "start":
                return self._derive(name, tables).where("listed")
            case "unlisted_service" | "unlisted_start":
                return self._derive(_source(name), tables).where("NOT listed")
            case "location":
                return tables.location
            case "fare":
                return tables.fare_table
            case "discount":
                return tables.transfer_discount_rules
        return self._derive(name, tables)

    def _derive(self, name: str, tables: Tables) -> DataFrame:
        if name not in self._derived:
            frame = _DERIVED[name](tables)
            # What is kept keeps its partitions, most of them empty if shuffles make many.
            self._derived[name] = frame.coalesce(KEPT_PARTITIONS).persist() if self._keep else frame
        return self._derived[name]


def _source(name: str) -> str:
    """The frame that a lookup is part of."""
    return name.removeprefix("unlisted_")


def within_budget(sizes: dict[str, int], most: int) -> set[str]:
    """The smallest of them, as many as stay within `most` together."""
    fitting, used = set(), 0
    for name in sorted(sizes, key=lambda name: (sizes[name], name)):
        used += sizes[name]
        if used > most:
            break
        fitting.add(name)
    return fitting


def measured_bytes(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Size of each frame's rows. Summed map-side, so the driver gets one number per frame."""

    def width(frame: DataFrame) -> Column:
        texts = [
            F.coalesce(F.octet_length(field.name), F.lit(0))
            for field in frame.schema
            if isinstance(field.dataType, (T.StringType, T.BinaryType))
        ]
        fields = [
            f
            for field in frame.schema
            for f in (field.dataType if isinstance(field.dataType, T.StructType) else [field])
        ]
        fixed = ROW_OVERHEAD_BYTES + 16 * len(fields)
        return reduce(Column.__add__, texts, F.lit(fixed)).cast("bigint")

    rows = reduce(
        DataFrame.unionAll,
        [
            frame.select(F.lit(name).alias("name"), width(frame).alias("bytes"))
            for name, frame in frames.items()
        ],
    )
    totals = rows.groupBy("name").agg(F.sum("bytes").alias("bytes"))
    found = {row["name"]: row["bytes"] for row in totals.collect()}
    return {name: found.get(name, 0) for name in frames}


def services(tables: Tables) -> DataFrame:
    """Each listed route of an operator, and a row per operator for rides on no listed route: its
    names, type and label.

    A ride without a route name takes the participant's route type that has none either.
    """
    participants = tables.participant.selectExpr("participant_id AS operator_id", "participant_name")
    listed = tables.route.selectExpr(
        "participant_id AS operator_id", "route_id", "route_name AS _route", "true AS listed"
    ).join(participants, "operator_id", "left")
    unlisted = participants.selectExpr(
        "operator_id",
        "CAST(NULL AS INT) AS route_id",
        "CAST(NULL AS STRING) AS _route",
        "false AS listed",
        "participant_name",
    )
    types = tables.route_type.withColumnRenamed("participant_name", "_participant")
    return (
        listed.union(unlisted)
        .join(
            types,
            (F.col("participant_name") == F.col("_participant"))
            & F.col("_route").eqNullSafe(F.col("route_name")),
            "left",
        )
        .withColumn("operator_name", operator_label(F.col("participant_name"), F.col("route_type")))
        .drop("_route", "_participant")
    )


def starts(tables: Tables) -> DataFrame:
    """Per key, the label and allowance of a ride as the first of a transfer.

    Where duplicate reference rows leave a choice, the longest allowance wins.
    """
    rules = tables.transfer_time_rules.selectExpr(
        "operator_transferred_from AS operator_name",
        "CAST(allowable_transfer_time AS INT) AS minutes",
        "allowable_transfer_time",
    )
    best = F.max(F.struct("minutes", "allowable_transfer_time", "operator_name"))
    return (
        services(tables)
        .join(rules, "operator_name", "left")
        .groupBy("operator_id", "route_id", "listed")
        .agg(best.alias("best"))
        .select("operator_id", "route_id", "listed", "best.*")
    )


def one_location(tables: Tables) -> DataFrame:
    return tables.location.groupBy("participant_id", "location_code").agg(
        F.max("location_name").alias("location_name")
    )


def contract_products(tables: Tables) -> DataFrame:
    issued = ["issuer_id", "product_type"]
    return tables.contract_product.join(tables.product, issued, "left").select(
        "contract_type", F.col("description").alias("product_name")
    )


def coupons(tables: Tables) -> DataFrame:
    return tables.coupon_contract.select("id").distinct().withColumn("is_coupon", F.lit(1))


_DERIVED = {
    "service": services,
    "start": starts,
    "one_location": one_location,
    "contract_product": contract_products,
    "coupon": coupons,
}


def attach_by_route(
    rows: DataFrame,
    listed: Lookup,
    unlisted: Lookup,
    operator: str,
    route: str,
    **wanted: str,
) -> DataFrame:
    """Attach from `listed` by operator and route, else from `unlisted` by operator alone."""
    mark = f"_listed_{next(iter(wanted))}"
    first = {f"_listed_as_{name}": source for name, source in wanted.items()}
    second = {f"_unlisted_as_{name}": source for name, source in wanted.items()}
    rows = listed.attach(rows, [operator, route], **{mark: "listed"}, **first)
    rows = unlisted.attach(rows, [F.when(F.col(mark).isNull(), F.col(operator))], **second)
    return rows.withColumns(
        {
            name: F.when(F.col(mark), F.col(f"_listed_as_{name}")).otherwise(
                F.col(f"_unlisted_as_{name}")
            )
            for name in wanted
        }
    )
