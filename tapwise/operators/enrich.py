"""Describing trips: names, products, flags, fares, transfers and discounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.operators.lookups import Lookups, attach_by_route

# Columns describing the transfer that led to a trip; all NULL if none did.
TRANSFER_CONTEXT = {
    "started_by_transfer": "transfer_flag",
    "operator_transferred_from": "trip_1_operator",
    "trip_1_origin_location_name": "trip_1_origin_location_name",
    "trip_1_destination_location_name": "trip_1_destination_location_name",
}


def operator_label(taps: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds participant_name, route_name, route_type and operator_name; NULL where unknown."""
    return attach_by_route(
        taps,
        lookups["service"],
        lookups["unlisted_service"],
        "operator_id",
        "route_id",
        participant_name="participant_name",
        route_name="route_name",
        route_type="route_type",
        operator_name="operator_name",
    )


def tap_locations(taps: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds origin_name and destination_name (NULL where unknown: they are lookup keys), and
    origin_location_name and destination_location_name (for showing)."""
    place = lookups["location"]
    taps = place.attach(taps, ["operator_id", "origin_location"], origin_name="location_name")
    taps = place.attach(
        taps, ["operator_id", "destination_location"], destination_name="location_name"
    )
    return taps.withColumns(
        {
            "origin_location_name": F.coalesce("origin_name", F.lit(V.UNKNOWN_NAME)),
            "destination_location_name": F.coalesce("destination_name", F.lit(V.UNKNOWN_NAME)),
        }
    )


def product_lookup(trips: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds product_name; a contract with several products yields a row for each."""
    return lookups["contract_product"].attach(trips, ["contract_id"], product_name="product_name")


def program_flags(
    trips: DataFrame, lookups: Lookups, program_contract: int = V.PROGRAM_CONTRACT
) -> DataFrame:
    """Adds start_flag (contract is in the coupon list) and program_flag, each 0 or 1."""
    trips = lookups["coupon"].attach(trips, ["contract_id"], start_flag="is_coupon")
    in_program = F.col("contract_id") == program_contract
    return trips.withColumns(
        {
            "start_flag": F.coalesce("start_flag", F.lit(0)),
            "program_flag": F.when(in_program, F.lit(1)).otherwise(F.lit(0)),
        }
    )


def adult_fare_lookup(located: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds estimated_adult_fare, by the participant's own name and not the operator's label.

    A place or route type that is unknown is looked up as a flat fare.
    """
    return lookups["fare"].attach(
        located,
        [
            "participant_name",
            F.coalesce("origin_name", F.lit(V.ANY_PLACE)),
            F.coalesce("destination_name", F.lit(V.ANY_PLACE)),
            F.coalesce("route_type", F.lit(V.ANY_PLACE)),
            F.coalesce("fare_year", F.lit(0)),
            F.coalesce("fare_month", F.lit(0)),
        ],
        estimated_adult_fare="adult_fare",
    )


def join_transfers(trips: DataFrame, transfers: DataFrame) -> DataFrame:
    """Adds the transfer context of the trips whose tag-on is the second of a transfer."""
    context = transfers.select(
        "card_id",
        F.col("trip_2_tag_on_time").alias("ride_start_time"),
        *[F.col(source).alias(name) for name, source in TRANSFER_CONTEXT.items()],
    )
    return trips.join(context, ["card_id", "ride_start_time"], "left")


def transfer_context(named: DataFrame) -> DataFrame:
    """Adds the transfer flags and where the transfer took place.

    Needs the columns of TRANSFER_CONTEXT, operator_name and origin_location_name.
    """
    transferred = F.col("started_by_transfer").isNotNull()
    before, now = F.col("operator_transferred_from"), F.col("operator_name")
    left_at = F.nullif(F.col("trip_1_destination_location_name"), F.lit(V.UNKNOWN_NAME))

    def flag(condition):
        return F.when(transferred & condition, F.lit(1)).otherwise(F.lit(0))

    return named.withColumns(
        {
            "transfer_flag": F.coalesce("started_by_transfer", F.lit(0)),
            "interop_transfer_flag": flag(before != now),
            "intraop_transfer_flag": flag(before == now),
            "transfer_location": F.when(
                transferred, F.coalesce(left_at, F.col("origin_location_name"))
            ),
        }
    )


def transfer_discount(priced: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds the estimated discount and the adult fare after it; an unknown fare counts as 0.

    The rule's rate is read as a whole number: text with a fraction is an error, and a fractional
    number is cut to its whole part.
    """
    priced = lookups["discount"].attach(
        priced,
        ["operator_transferred_from", "operator_name"],
        _rate="transfer_discount_available",
    )
    fare = F.coalesce("estimated_adult_fare", F.lit(0))
    discount = F.coalesce(F.col("_rate").cast("int") * fare, F.lit(0))
    return priced.withColumns(
        {
            "estimated_transfer_discount": discount,
            "estimated_adult_fare_with_transfers": fare - discount,
        }
    )


def describe_trips(trips: DataFrame, lookups: Lookups) -> DataFrame:
    """Everything known about trips that already carry their transfer context."""
    trips = operator_label(trips, lookups)
    trips = tap_locations(trips, lookups)
    trips = product_lookup(trips, lookups)
    trips = program_flags(trips, lookups)
    trips = adult_fare_lookup(trips, lookups)
    trips = transfer_context(trips)
    trips = transfer_discount(trips, lookups)
    return trips.withColumns(
        {
            "route_name": F.coalesce("route_name", F.lit(V.NO_ROUTE)),
            "route_type_name": F.coalesce("route_type", F.lit(V.NO_ROUTE)),
        }
    )
