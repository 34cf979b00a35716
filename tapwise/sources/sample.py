"""Fare-card inputs made from the `events` table, for the registered queries and the tests.

Every event is a tap, and most rides that start with a click or purchase get a tag-off too, so the
taps grow with `events`. The reference data is small and fixed, as it is in life.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapwise.operators.lookups import Lookups
from tapwise.sources.statistics import TapStatistics, count_taps, summed_up
from tapwise.sources.tables import Tables

PARTICIPANTS = (
    "Golden Gate Transit",
    "Napa Solano",
    "East Bay",
    "Corridor 101",
    "Metro Rail",
    "Bay Ferry",
    "City Bus",
    "Coast Rail",
)
PLACES = 5
# Participants from here on have no fares.
FARE_PARTICIPANTS = 6

# participant, number of its route (None: rides without a route name), route type
ROUTE_TYPES = (
    ("Golden Gate Transit", 0, "Marin Transit Route"),
    ("Golden Gate Transit", 1, "Basic"),
    ("Golden Gate Transit", None, "Unrouted"),
    ("Napa Solano", 0, "FAST Local"),
    ("Napa Solano", 1, "Napa VINE Local"),
    ("Napa Solano", 2, "SolTrans Express"),
    ("Napa Solano", 3, "Vacaville Local"),
    ("Napa Solano", None, "Napa VINE Express"),
    ("East Bay", 0, "County Connection Local"),
    ("East Bay", 1, "TriDelta Local"),
    ("East Bay", 2, "WestCAT Express"),
    ("East Bay", 3, "Wheels Local"),
    ("Corridor 101", 0, "Petaluma Transit Local Route"),
    ("Corridor 101", 1, "Santa Rosa City Bus Local Route"),
    ("Metro Rail", 0, "Rail"),
    ("Metro Rail", None, "Rail"),
)
COUPONS = (3, 5, 7)
TIME_RULES = (
    ("Marin Transit", "120"),
    ("FAST", "60"),
    ("Napa Vine", "60"),
    ("County Connection", "120"),
    ("WestCAT", "120"),
    ("Metro Rail", "120"),
    ("City Bus", "90"),
    ("Golden Gate Transit", "180"),
)
DISCOUNT_RULES = (
    ("Marin Transit", "Metro Rail", "1"),
    ("Metro Rail", "Napa Vine", "1"),
    ("Metro Rail", "City Bus", "1"),
    ("City Bus", "Metro Rail", "1"),
    ("Golden Gate Transit", "City Bus", "0"),
    ("City Bus", "City Bus", "1"),
    ("Metro Rail", "Metro Rail", "0"),
    ("Golden Gate Transit", "East Bay", "1"),
    ("Metro Rail", "East Bay", "1"),
    ("Golden Gate Transit", "Metro Rail", "1"),
)


def route_name(participant: str, number: int | None) -> str | None:
    return None if number is None else f"{participant} R{number}"


def fixed_rows() -> dict[str, tuple[tuple[str, ...], list[tuple]]]:
    """Reference data other than fares: table -> (columns, rows)."""
    ids = list(enumerate(PARTICIPANTS))
    places = [(i, name, k) for i, name in ids for k in range(PLACES)]
    return {
        "participant": (("participant_id", "participant_name"), ids),
        "location": (
            ("participant_id", "location_code", "location_name"),
            [(i, k, f"{name} L{k}") for i, name, k in places],
        ),
        "route": (
            ("participant_id", "route_id", "route_name"),
            # An operator's last route has no name.
            [(i, k, route_name(name, k if k < PLACES - 1 else None)) for i, name, k in places],
        ),
        "route_type": (
            ("participant_name", "route_name", "route_type"),
            [(name, route_name(name, number), kind) for name, number, kind in ROUTE_TYPES],
        ),
        "coupon_contract": (("id",), [(i,) for i in COUPONS]),
        "contract_product": (
            ("contract_type", "issuer_id", "product_type"),
            [(k, k % 3, k % 4) for k in range(16)] + [(520, 0, 0)],
        ),
        "product": (
            ("issuer_id", "product_type", "description"),
            [
                (issuer, kind, f"Product {issuer}-{kind}")
                for issuer in range(3)
                for kind in range(4)
                if (issuer, kind) != (2, 3)
            ],
        ),
        "transfer_time_rules": (
            ("operator_transferred_from", "allowable_transfer_time"),
            list(TIME_RULES),
        ),
        "transfer_discount_rules": (
            (
                "operator_transferred_from",
                "operator_transferred_to",
                "transfer_discount_available",
            ),
            list(DISCOUNT_RULES),
        ),
    }


def values_sql(columns: tuple[str, ...], rows: list[tuple]) -> str:
    """Rows as a SELECT over VALUES."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    lines = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {lines}) AS v({', '.join(columns)})"


def fare_types() -> list[tuple[str, str]]:
    """(participant, route type) having fares; every participant has fares of any type, '0'."""
    kinds = [(name, kind) for name, _, kind in ROUTE_TYPES] + [(name, "0") for name in PARTICIPANTS]
    return [
        (name, kind)
        for name, kind in dict.fromkeys(kinds)
        if PARTICIPANTS.index(name) < FARE_PARTICIPANTS
    ]


def taps(events: DataFrame) -> DataFrame:
    """Taps from events, read once: an event may be a tag-on with its tag-off.

    One ride in five that starts with a click or purchase ends without a tag-off. Odd cards ride in
    the second half of the year.
    """
    return _taps_of_events(events).drop("event_id")


def odd_taps(events: DataFrame) -> DataFrame:
    """The same taps, but some without a card, some twice, and some tag-ons with another one at the same instant
    that charged 50 more."""
    found = _taps_of_events(events).withColumn("card_id", F.expr("if(event_id % 37 = 0, NULL, card_id)"))
    copies = found.where("event_id % 41 = 0")
    more = found.where("event_id % 29 = 0 AND fare_transaction_sub_type IN (1, 2, 4)")
    more = more.withColumn("purse_amount", F.col("purse_amount") + 50)
    return found.unionAll(copies).unionAll(more).drop("event_id")


def _taps_of_events(events: DataFrame) -> DataFrame:
    first = """named_struct('code',
        CASE WHEN event_type = 'error' THEN 3 + 2 * (event_id % 2)
             WHEN event_type = 'click' THEN 2
             WHEN event_type = 'purchase' THEN 4
             WHEN event_id % 97 = 0 THEN 9
             ELSE 1 END, 'amount', cents)"""
    last = "named_struct('code', if(event_type = 'click', 3L, 5L), 'amount', cents % 300)"
    ends = "event_type IN ('click', 'purchase') AND event_id % 5 <> 0"
    return (
        events.selectExpr("*", "CAST(round(value * 100) AS BIGINT) AS cents")
        .selectExpr(
            "*", f"explode(CASE WHEN {ends} THEN array({first}, {last}) ELSE array({first}) END) AS tap"
        )
        .selectExpr(
            "event_id",
            "user_id AS card_id",
            "ts + if(user_id % 2 = 1, INTERVAL '182' DAY, INTERVAL '0' DAY) AS ride_start_time",
            "CAST((event_id * 7 + user_id) % 9 AS INT) AS operator_id",
            "CAST((event_id * 5) % 7 AS INT) AS origin_location",
            "CAST((event_id * 3 + 1) % 7 AS INT) AS destination_location",
            "CAST(tap.code AS INT) AS fare_transaction_sub_type",
            "CAST((event_id * 11) % 6 AS INT) AS route_id",
            "CAST(user_id % 5 AS INT) AS fare_category",
            "(event_id % 3) * 25 AS fare_discount",
            "tap.amount AS purse_amount",
            "CAST(if(event_id % 10 = 0, 520, event_id % 23) AS INT) AS contract_id",
            "CAST(nullif(user_id % 11, 10) AS INT) AS institution_id",
        )
    )


def fares(spark: SparkSession) -> DataFrame:
    """A fare per participant, pair of places, route type and half-year; place '0' is any place."""

    def place(number: str):
        named = F.concat("operator", F.lit(" L"), F.col(number).cast("string"))
        return F.when(F.col(number) == PLACES, F.lit("0")).otherwise(named)

    numbers = F.sequence(F.lit(0), F.lit(PLACES))
    rise = F.when(F.col("fare_month") == 7, F.lit(1)).otherwise(F.lit(0))
    return (
        spark.sql(values_sql(("operator", "route_type"), fare_types()))
        .withColumn("o", F.explode(numbers))
        .withColumn("d", F.explode(numbers))
        .withColumn("fare_month", F.explode(F.array(F.lit(1), F.lit(7))))
        .select(
            "operator",
            place("o").alias("origin_location"),
            place("d").alias("destination_location"),
            "route_type",
            F.lit(2024).alias("fare_year"),
            "fare_month",
            (2 + 0.25 * (F.col("o") + F.col("d")) + rise).cast("decimal(10,2)").alias("adult_fare"),
        )
    )


@lru_cache(maxsize=1)
def reference_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Reference data, defined once per session."""
    fixed = {
        table: spark.sql(values_sql(columns, rows)) for table, (columns, rows) in fixed_rows().items()
    }
    return fixed | {"fare_table": fares(spark)}


def sample_tables(spark: SparkSession, sf_dir: str, made=taps) -> Tables:
    """Inputs from the events in `sf_dir`; `made` makes the taps."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return Tables(taps=made(events), **reference_tables(spark))


@lru_cache(maxsize=1)
def sample_lookups(spark: SparkSession) -> Lookups:
    """All lookups, made once per session; they don't depend on the taps."""
    return Lookups(Tables(taps=None, **reference_tables(spark)), keep=True)


_statistics: dict[tuple, TapStatistics] = {}


def sample_statistics(tables: Tables) -> TapStatistics:
    """The taps' statistics, held by the executors and found once for each state of the files that the taps are made of."""
    spark = tables.taps.sparkSession
    files = []
    for name in sorted(tables.taps.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append((name, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, *files)
    if key not in _statistics:
        _statistics[key] = summed_up(count_taps(tables.taps).persist())
    return _statistics[key]
