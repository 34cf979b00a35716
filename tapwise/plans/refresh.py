"""The full refresh: rebuild the newest period and republish the union of all periods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tapwise.functions import values as V
from tapwise.operators.lookups import Lookups
from tapwise.plans.publish import members, publish_period
from tapwise.plans.trips import enriched_trips
from tapwise.sources.statistics import TapStatistics
from tapwise.sources.tables import Tables


def refresh(
    tables: Tables,
    history: Mapping[str, DataFrame],
    target: str,
    since: str = V.SINCE,
    folder: str | None = None,
    period: str = "newest",
    statistics: TapStatistics | None = None,
    look_back: bool = False,
) -> DataFrame:
    """Rebuild the period from `since` on, and publish it with all earlier ones as view `target`.

    `history` names the earlier periods. Those that `target` does not have yet are stored first; those it has
    are neither read nor written again. So a refresh costs what the newest period costs, however long
    the history. `plans.publish` says how each is stored, switched and replaced; `statistics` and
    `look_back` are those of `plans.trips.enriched_trips`.
    """
    spark = tables.taps.sparkSession
    if period in history:
        raise ValueError(f"{period!r} is the period to rebuild, and can't be an earlier one")
    for name, rows in history.items():
        if name not in members(spark, target):
            publish_period(rows, target, name, folder)
    lookups = Lookups(tables, keep=True)
    try:
        newest = enriched_trips(tables, since, lookups, statistics=statistics, look_back=look_back)
        return publish_period(newest, target, period, folder)
    finally:
        lookups.release()
