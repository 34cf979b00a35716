"""Column expressions shared by the operators. All are built-ins, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapwise.functions import values as V


def fare_category_name(
    code: Column,
    names: Mapping[int, str] = V.FARE_CATEGORIES,
    other: str = V.OTHER_FARE_CATEGORY,
) -> Column:
    """Rider category; a NULL or unlisted code is `other`."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, code), F.lit(other))


def operator_label(
    participant: Column,
    route_type: Column,
    labels: Sequence[tuple[str, tuple[str, ...], str]] = V.OPERATOR_LABELS,
) -> Column:
    """Name of the agency that ran the ride: the first label that fits, else the participant."""

    def fits(route: str) -> Column:
        if route.endswith("*"):
            return route_type.startswith(route[:-1])
        return route_type == route

    candidates = [
        F.when((participant == who) & reduce(Column.__or__, map(fits, routes)), F.lit(label))
        for who, routes, label in labels
    ]
    return F.coalesce(*candidates, participant)


def tag_off_charge(
    sub_type: Column,
    off_amount: Column,
    on_amount: Column | None = None,
    refund: int = V.REFUND_CODE,
    plain: int = V.PLAIN_TAG_OFF_CODE,
) -> Column:
    """Charge of a tag-off. A refund is taken off what its tag-on charged, if there is one."""
    refunded = -off_amount if on_amount is None else on_amount - off_amount
    return F.when(sub_type == refund, refunded).when(sub_type == plain, off_amount)


def fare_year(time: Column) -> Column:
    return F.year(time)


def fare_month(time: Column) -> Column:
    """First month of the half-year the time lies in: 1 or 7."""
    return F.when(F.month(time) > 6, F.lit(7)).otherwise(F.lit(1))


def minutes(n: Column) -> Column:
    """Interval of n minutes; NULL if n is."""
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, n, F.lit(0).cast("decimal(18,6)"))


def microsecond_number(time: str) -> Column:
    """Wall-clock microseconds since 1970 of a column, never through a time zone."""
    return F.expr(_microsecond_number(time))


def moment(time: str, side: str) -> Column:
    """A number to order taps by: instants are at least 4 apart, and within an instant tag-ons
    (side 0) come 1 before tag-offs (side 1)."""
    return F.expr(f"({_microsecond_number(time)}) * 4 + {side}")


def _microsecond_number(time: str) -> str:
    micros = f"CAST(extract(SECOND FROM {time}) * 1000000 AS BIGINT) % 1000000"
    return f"({_second_number(time)}) * 1000000 + {micros}"


def _second_number(time: str) -> str:
    days = f"CAST(unix_date(CAST({time} AS DATE)) AS BIGINT)"
    return f"(({days} * 24 + hour({time})) * 60 + minute({time})) * 60 + second({time})"
