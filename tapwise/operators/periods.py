"""Merging period tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.schema import OUTPUT_COLUMNS

TIME = "ride_start_time"


@dataclass(frozen=True)
class Span:
    """The first and last ride start of some rows (None: no row has one), and whether any row has none."""

    first: datetime | None
    last: datetime | None
    timeless: bool = False


def spans_of(periods: Sequence[DataFrame]) -> list[Span]:
    """The periods' spans, in one job that reads one column."""
    parts = [
        period.agg(
            F.lit(i).alias("i"), F.min(TIME).alias("first"), F.max(TIME).alias("last"),
            F.coalesce(F.max(F.col(TIME).isNull()), F.lit(False)).alias("timeless"),
        )
        for i, period in enumerate(periods)
    ]
    if not parts:
        return []
    rows = sorted(reduce(DataFrame.unionAll, parts).collect())
    return [Span(row["first"], row["last"], row["timeless"]) for row in rows]


def overlaps(spans: Sequence[Span]) -> list[tuple[datetime, datetime]]:
    """The stretches of time, ends included, that lie in more than one span; joined where they touch."""
    known = [s for s in spans if s.first is not None]
    shared = sorted(
        (max(a.first, b.first), min(a.last, b.last))
        for i, a in enumerate(known)
        for b in known[:i]
        if max(a.first, b.first) <= min(a.last, b.last)
    )
    joined: list[tuple[datetime, datetime]] = []
    for first, last in shared:
        if joined and first <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(last, joined[-1][1]))
        else:
            joined.append((first, last))
    return joined


def shared_rows(spans: Sequence[Span]) -> str | None:
    """SQL that is true of rows which more than one period may have, by their ride start; None if there are none."""
    within = [
        f"{TIME} BETWEEN TIMESTAMP_NTZ '{first}' AND TIMESTAMP_NTZ '{last}'" for first, last in overlaps(spans)
    ]
    timeless = sum(s.timeless for s in spans) > 1
    if not within and not timeless:
        return None
    return f"coalesce({' OR '.join(within) or 'false'}, {str(timeless).lower()})"


def all_period_trips(
    periods: Sequence[DataFrame], sets: bool = False, spans: Sequence[Span] | None = None
) -> DataFrame:
    """All periods as one set of rows, matched by column position.

    Rows that periods share, or that differ in no output column, appear once. If each period is known to be a
    set already (`sets`), only rows whose ride start lies in the spans of several are compared and
    shuffled; the others go through. `spans` are those of the periods, if they are known; else a job finds them.
    """
    named = [period.toDF(*OUTPUT_COLUMNS) for period in periods]
    if not sets:
        return reduce(DataFrame.union, named).distinct()
    shared = shared_rows(spans_of(named) if spans is None else spans)
    if shared is None:
        return reduce(DataFrame.union, named)
    alone = [period.where(f"NOT {shared}") for period in named]
    several = reduce(DataFrame.union, [period.where(shared) for period in named]).distinct()
    return reduce(DataFrame.union, [*alone, several])
