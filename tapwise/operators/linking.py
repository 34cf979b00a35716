"""Looking back from a tap to the card's tag-on before it, without one task per card.

Taps are brought together by (card, slice). An ordinary card is one slice. A card with very many
taps is cut by time into slices of about equal numbers of taps; what a slice must know of the time
before it, the card's last tag-on, is summed up per slice first. No pair of taps is ever formed.

Ordinary cards and heavy ones are branches of their own: what heavy cards need besides costs the
others nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapwise.functions import values as V
from tapwise.functions.expressions import microsecond_number, minutes, moment
from tapwise.operators.lookups import Lookup, Lookups, attach_by_route, measured_bytes
from tapwise.schema import TAP_COLUMNS
from tapwise.sources.statistics import TapStatistics

LINK_LOOKUPS = ("start", "unlisted_start", "one_location")

# A card with more taps than this is cut into slices of about this size.
SLICE_ROWS = 250_000

HOUR, SECOND = 3_600_000_000, 1_000_000

# What is remembered of a tag-on. Latest first, then longest allowance; the rest settles ties
# between taps at one instant, where any choice is valid.
_REMEMBERED = (
    "ride_start_time",
    "minutes",
    "operator_id",
    "route_id",
    "origin_location",
    "destination_location",
)


@dataclass(frozen=True)
class Slices:
    """Which cards are heavy, where their time is cut, and each slice's last tag-on before it. All
    are None if no card is heavy; `cuts` and `before` also where only the cards were asked for."""

    cards: Lookup | None = None
    cuts: Lookup | None = None
    before: Lookup | None = None

    @classmethod
    def measure(
        cls,
        taps: DataFrame,
        slice_rows: int,
        broadcast_bytes: int,
        statistics: TapStatistics | None = None,
    ) -> Slices:
        """Only which cards are heavy. `statistics` of a table that holds all of `taps` spare
        reading the taps for that, and any job at all if no card of it is big enough."""
        if statistics is None:
            heavy = heavy_cards(taps, slice_rows)
        elif statistics.largest <= slice_rows:
            return cls()
        else:
            heavy = statistics.cards_above(slice_rows)
        return cls(_measured(heavy, broadcast_bytes, "card_id")[0])

    @classmethod
    def of(
        cls,
        taps: DataFrame,
        lookups: Lookups,
        slice_rows: int = SLICE_ROWS,
        statistics: TapStatistics | None = None,
    ) -> Slices:
        """All of it; `taps` have the column `side`. Only the heavy cards' taps are read for the rest.
        Each is broadcast if the lookups and those before it leave room for it."""
        found = cls.measure(taps, slice_rows, lookups.bytes_left, statistics)
        if found.cards is None:
            return found
        cards, left = found.cards, lookups.bytes_left - (found.cards.bytes if found.cards.small else 0)
        cuts, left = _measured(cut_times(found.heavy(taps), slice_rows), left, "card_id", "hour")
        if cuts is None:
            return cls()
        found = cls(cards, cuts)
        last = (
            with_allowance(found.place(found.heavy(taps.where("side = 0"))), lookups)
            .groupBy("card_id", "slice")
            .agg(F.max(F.struct(*_REMEMBERED)).alias("last"))
        )
        by_slice = Window.partitionBy("card_id").orderBy("slice")
        before = last.select("card_id", "slice", F.lag("last").over(by_slice).alias("before"))
        before = before.where("before IS NOT NULL")
        return cls(cards, cuts, _measured(before, left, "card_id", "slice")[0])

    def _marked(self, taps: DataFrame) -> DataFrame:
        return self.cards.attach(taps, ["card_id"], _heavy="taps")

    def heavy(self, taps: DataFrame) -> DataFrame:
        return self._marked(taps).where("_heavy IS NOT NULL").select(*taps.columns)

    def ordinary(self, taps: DataFrame) -> DataFrame:
        if self.cards is None:
            return taps
        return self._marked(taps).where("_heavy IS NULL").select(*taps.columns)

    def place(self, heavy: DataFrame) -> DataFrame:
        """Heavy cards' taps with their `slice`: that of the last cut of their hour up to them."""
        columns = heavy.columns
        heavy = heavy.withColumns({"_micros": microsecond_number("ride_start_time")})
        heavy = heavy.withColumn("_hour", F.floor(F.col("_micros") / HOUR))
        heavy = self.cuts.attach(heavy, ["card_id", "_hour"], _starts="starts")
        begun = F.filter("_starts", lambda cut: cut["start"] <= F.col("_micros"))
        return heavy.select(*columns, F.element_at(begun, -1)["slice"].alias("slice"))

    def attach_before(self, taps: DataFrame) -> DataFrame:
        """Where a row's slice holds no tag-on before it, makes `latest` the one from an earlier
        slice."""
        if self.before is None:
            return taps
        taps = self.before.attach(taps, ["card_id", "slice"], before="before")
        return taps.withColumn("latest", F.coalesce("latest", "before"))


def _measured(frame: DataFrame, broadcast_bytes: int, *keys: str) -> tuple[Lookup | None, int]:
    """A lookup made from taps, or None if it has no rows, and what it leaves of `broadcast_bytes`. It is written to
    the checkpoint folder, if there is one, so that its taps aren't read again each time it is used."""
    frame = _kept(frame)
    size = measured_bytes({"": frame})[""]
    small = size <= broadcast_bytes
    found = Lookup(frame, keys, small, size) if size else None
    return found, broadcast_bytes - (size if small else 0)


def heavy_cards(taps: DataFrame, slice_rows: int) -> DataFrame:
    """Cards with more than `slice_rows` taps, and how many. Taps without a card are nobody's, and
    never cut."""
    counted = taps.where("card_id IS NOT NULL").groupBy("card_id").agg(F.count(F.lit(1)).alias("taps"))
    return counted.where(F.col("taps") > slice_rows)


def cut_times(heavy: DataFrame, slice_rows: int) -> DataFrame:
    """Per card and hour the `starts` of the slices that its taps may lie in: (start in microseconds, slice).

    The taps are counted by instant in one pass, in which tasks combine theirs, and added up by hour. A bin
    belongs to the slice in which its first tap falls, counted from the card's beginning. Hours with more than a
    slice's taps are looked at by the second, such seconds by the instant. So no slice has more than twice
    `slice_rows` taps, unless one instant has. Each window orders the hours of a card, the seconds of an
    hour, or the instants of a second: never all of a card's taps.
    """
    n = F.sum("n").alias("n")
    instants = heavy.groupBy("card_id", microsecond_number("ride_start_time").alias("start"))
    instants = instants.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {
            "hour": F.floor(F.col("start") / HOUR),
            "second": F.floor(F.col("start") / SECOND),
        }
    )
    instants = _kept(instants)

    def numbered(bins: DataFrame, *parent: str) -> DataFrame:
        """Adds `slice`; `base` is how many of the card's taps come before the parent's."""
        earlier = Window.partitionBy(*parent).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
        return bins.withColumn("before", before).withColumn("slice", F.floor(F.col("before") / slice_rows))

    def inside(hot: DataFrame, *parent: str) -> DataFrame:
        return instants.join(hot.where(F.col("n") > slice_rows).select(*parent, F.col("before").alias("base")), [*parent])

    hours = instants.groupBy("card_id", "hour").agg(n).withColumns(
        {"start": F.col("hour") * HOUR, "base": F.lit(0).cast("bigint")}
    )
    hours = numbered(hours, "card_id")
    seconds = inside(hours, "card_id", "hour").groupBy("card_id", "hour", "second", "base").agg(n)
    seconds = numbered(seconds.withColumn("start", F.col("second") * SECOND), "card_id", "hour")
    single = numbered(inside(seconds, "card_id", "hour", "second"), "card_id", "hour", "second")
    bins = [
        found.select("card_id", "hour", "slice", "start")
        for found in (hours.where(F.col("n") <= slice_rows), seconds.where(F.col("n") <= slice_rows), single)
    ]
    cuts = reduce(DataFrame.unionAll, bins).groupBy("card_id", "hour", "slice").agg(F.min("start").alias("start"))
    starts = F.sort_array(F.collect_list(F.struct("start", "slice")))
    return cuts.groupBy("card_id", "hour").agg(starts.alias("starts"))


def _kept(frame: DataFrame) -> DataFrame:
    return frame.checkpoint() if frame.sparkSession.sparkContext.getCheckpointDir() else frame


def with_allowance(taps: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds `minutes`: how long a transfer from this tap may take, NULL if it cannot start one."""
    return attach_by_route(
        taps,
        lookups["start"],
        lookups["unlisted_start"],
        "operator_id",
        "route_id",
        minutes="minutes",
    )


# A card's taps in time order, within a slice; `bring_together` puts them so.
BY_MOMENT = ("card_id", "slice", "moment")


def bring_together(
    taps: DataFrame,
    lookups: Lookups,
    slices: Slices,
    look: Callable[[DataFrame], DataFrame],
    *columns: str,
) -> DataFrame:
    """`look` at `columns` of the taps without copies, a card and slice in one place and in time order.

    `look` may ask for windows over BY_MOMENT. It sees ordinary cards by themselves, which are shuffled
    once, and heavy ones, whose taps may be copies of one another: of these, copies are dropped within
    each task first, at the price of a shuffle by whole rows.
    """

    def ordered(placed: DataFrame) -> DataFrame:
        return (
            with_allowance(placed, lookups)
            .select(*columns, "side", "slice", "minutes", moment("ride_start_time", "side").alias("moment"))
            .sortWithinPartitions(*BY_MOMENT)
        )

    taps = taps.select(*columns, "side")
    # Taps without a card pair with nothing, so they go anywhere, evenly.
    anywhere = F.xxhash64(*[c for c in TAP_COLUMNS if c in columns])
    whole = F.when(F.col("card_id").isNull(), anywhere).otherwise(F.lit(0).cast("bigint"))
    ordinary = slices.ordinary(taps).withColumn("slice", whole).repartition("card_id", "slice").distinct()
    looked = look(ordered(ordinary))
    if slices.cards is None:
        return looked
    heavy = slices.place(slices.heavy(taps).distinct()).repartition("card_id", "slice")
    return looked.unionByName(slices.attach_before(look(ordered(heavy))).select(*looked.columns))


def place_rides(taps: DataFrame, slices: Slices, look: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`look` at the taps without copies, those of one ride in one place and in the order of `side`; branches
    as in `bring_together`."""
    ride = ("card_id", "ride_start_time")
    looked = look(slices.ordinary(taps).repartition(*ride).distinct().sortWithinPartitions(*ride, "side"))
    if slices.cards is None:
        return looked
    heavy = slices.heavy(taps).distinct().repartition(*ride)
    return looked.unionByName(look(heavy.sortWithinPartitions(*ride, "side")))


def latest_tag_on(card: WindowSpec) -> Column:
    """The last tag-on strictly before a row, looking back along `moment`."""
    is_tag_on = (F.col("side") == 0) & F.col("card_id").isNotNull()
    tag_on = F.when(is_tag_on, F.struct(*_REMEMBERED))
    # Two back from a tap's moment lies before every tap of its instant.
    return F.max(tag_on).over(card.rangeBetween(Window.unboundedPreceding, -2))


def within_allowance() -> Column:
    """`latest`, if the row is within its allowance.

    It is enough to look at the last tag-on. If an earlier one had the row within its allowance, it
    had this one within it too, and sooner.
    """
    end = F.col("latest.ride_start_time") + minutes(F.col("latest.minutes"))
    return F.when(F.col("ride_start_time") < end, F.col("latest"))


def name_first_tap(rows: DataFrame, lookups: Lookups) -> DataFrame:
    """Adds what describes `first`, the first tap of a transfer; NULL where there is none."""
    transferred = F.col("first").isNotNull()
    rows = rows.withColumns(
        {
            "trip_1_tag_on_time": F.col("first.ride_start_time"),
            "_operator_1": F.col("first.operator_id"),
            "_route_1": F.col("first.route_id"),
            "_origin_1": F.col("first.origin_location"),
            "_destination_1": F.col("first.destination_location"),
            "transfer_flag": F.when(transferred, F.lit(1)),
        }
    )
    rows = attach_by_route(
        rows,
        lookups["start"],
        lookups["unlisted_start"],
        "_operator_1",
        "_route_1",
        trip_1_operator="operator_name",
        allowable_transfer_time="allowable_transfer_time",
    )
    place = lookups["one_location"]
    rows = place.attach(rows, ["_operator_1", "_origin_1"], _origin_name_1="location_name")
    rows = place.attach(rows, ["_operator_1", "_destination_1"], _destination_name_1="location_name")

    def shown(name: str) -> Column:
        return F.when(F.col("transfer_flag") == 1, F.coalesce(name, F.lit(V.UNKNOWN_NAME)))

    return rows.withColumns(
        {
            "trip_1_origin_location_name": shown("_origin_name_1"),
            "trip_1_destination_location_name": shown("_destination_name_1"),
        }
    )
