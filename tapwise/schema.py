"""Table shapes: column names, and the order of columns wherever a union relies on it."""

from __future__ import annotations

TAP_COLUMNS = (
    "card_id",
    "ride_start_time",
    "operator_id",
    "origin_location",
    "destination_location",
    "fare_transaction_sub_type",
    "route_id",
    "fare_category",
    "fare_discount",
    "purse_amount",
    "contract_id",
    "institution_id",
)

SUBSET_COLUMNS = (*TAP_COLUMNS, "fare_category_name")

CHARGED_COLUMNS = (*SUBSET_COLUMNS, "fare_charged")

TRIP_COLUMNS = (*CHARGED_COLUMNS, "trip_type", "fare_year", "fare_month")

TRANSFER_COLUMNS = (
    "card_id",
    "trip_1_operator",
    "trip_1_tag_on_time",
    "trip_2_tag_on_time",
    "trip_1_origin_location_name",
    "trip_1_destination_location_name",
    "allowable_transfer_time",
    "transfer_flag",
)

OUTPUT_COLUMNS = (
    "card_id",
    "ride_start_time",
    "trip_type",
    "fare_discount",
    "fare_charged",
    "fare_category_name",
    "institution_id",
    "operator_name",
    "origin_location_name",
    "destination_location_name",
    "product_name",
    "start_flag",
    "program_flag",
    "route_name",
    "route_type_name",
    "estimated_adult_fare",
    "transfer_flag",
    "operator_transferred_from",
    "interop_transfer_flag",
    "intraop_transfer_flag",
    "transfer_location",
    "trip_1_origin_location_name",
    "trip_1_destination_location_name",
    "estimated_transfer_discount",
    "estimated_adult_fare_with_transfers",
)

# Columns each input must have, by table.
INPUT_COLUMNS = {
    "taps": TAP_COLUMNS,
    "participant": ("participant_id", "participant_name"),
    "location": ("participant_id", "location_code", "location_name"),
    "route": ("participant_id", "route_id", "route_name"),
    "route_type": ("participant_name", "route_name", "route_type"),
    "coupon_contract": ("id",),
    "contract_product": ("contract_type", "issuer_id", "product_type"),
    "product": ("issuer_id", "product_type", "description"),
    "fare_table": (
        "operator",
        "origin_location",
        "destination_location",
        "route_type",
        "fare_year",
        "fare_month",
        "adult_fare",
    ),
    "transfer_time_rules": ("operator_transferred_from", "allowable_transfer_time"),
    "transfer_discount_rules": (
        "operator_transferred_from",
        "operator_transferred_to",
        "transfer_discount_available",
    ),
}
