"""Index membership: who is in the latest snapshot, who is new, who left, who was in when.

With `as_of` snapshots after it change nothing. Without it all snapshots count.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.sizing import broadcast_if_fits
from tickerloom.functions.timeline import at, until, with_previous

ATTRIBUTES = ["security", "gics_sector", "gics_sub_industry"]


def known_snapshots(snapshots: DataFrame, as_of: datetime | None) -> DataFrame:
    """The rows of snapshots taken until `as_of`."""
    return snapshots if as_of is None else snapshots.filter(until(snapshots, as_of, "updated_at"))


def latest_company(snapshots: DataFrame, members_only: bool = False,
                   as_of: datetime | None = None) -> DataFrame:
    """Newest attributes of every symbol ever seen, under report names.

    `members_only` leaves out symbols that the latest snapshot no longer has. Equal
    times fall back to the smallest attributes. The row limit per symbol is
    applied before the shuffle as well, so a symbol with many copies is no burden.
    """
    snapshots = known_snapshots(snapshots, as_of)
    newest = Window.partitionBy("symbol").orderBy(
        F.desc("updated_at"), *[F.asc_nulls_last(a) for a in ATTRIBUTES]
    )
    newest_rows = snapshots.withColumn("_position", F.row_number().over(newest)).filter(
        F.col("_position") == 1
    )
    if members_only:
        # One broadcast row by construction.
        latest = F.broadcast(snapshot_times(snapshots, 1))
        newest_rows = newest_rows.join(latest, "updated_at", "left_semi")
    return _reported(newest_rows)


def _reported(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("symbol").alias("ticker"),
        F.col("security").alias("name"),
        F.col("gics_sector").alias("sector"),
        F.col("gics_sub_industry").alias("industry"),
    )


def snapshot_times(snapshots: DataFrame, count: int = 2,
                   as_of: datetime | None = None) -> DataFrame:
    """The newest `count` distinct snapshot times; a missing time is none."""
    known = known_snapshots(snapshots, as_of)
    times = known.select("updated_at").filter(F.col("updated_at").isNotNull()).distinct()
    return times.orderBy(F.desc("updated_at")).limit(count)


def _last_two(snapshots: DataFrame, as_of: datetime | None) -> DataFrame:
    """Two rows: the latest time as rank 1, the one before it as rank 2 or null."""
    times = snapshot_times(snapshots, 2, as_of).agg(
        F.max("updated_at").alias("latest"),
        F.when(F.count("*") == 2, F.min("updated_at")).alias("previous"),
    )
    return times.select(F.inline(F.array(
        F.struct(F.col("latest").alias("updated_at"), F.lit(1).alias("_rank")),
        F.struct(F.col("previous").alias("updated_at"), F.lit(2).alias("_rank")),
    )))


def _in_last_two(snapshots: DataFrame, as_of: datetime | None) -> DataFrame:
    # The broadcast side has two rows by construction.
    return snapshots.select("symbol", "updated_at").join(
        F.broadcast(_last_two(snapshots, as_of)), "updated_at"
    )


def _members_at(snapshots: DataFrame, rank: int, as_of: datetime | None) -> DataFrame:
    return (_in_last_two(snapshots, as_of).filter(F.col("_rank") == rank)
            .select("symbol").distinct())


def latest_members(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return _members_at(snapshots, 1, as_of)


def previous_members(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Symbols of the snapshot before the latest; empty when there is only one."""
    return _members_at(snapshots, 2, as_of)


def snapshot_diff(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Every symbol of the last two snapshots as `added`, `removed` or `retained`.

    One aggregate over the rows of both snapshots, instead of two distinct sets
    and a join between them; a null symbol is compared like any other.
    """
    return (
        _in_last_two(snapshots, as_of)
        .groupBy("symbol")
        .agg(
            F.max(F.col("_rank") == 1).alias("_in_latest"),
            F.max(F.col("_rank") == 2).alias("_in_previous"),
        )
        .select(
            "symbol",
            F.when(~F.col("_in_previous"), "added")
            .when(~F.col("_in_latest"), "removed")
            .otherwise("retained")
            .alias("status"),
        )
    )


def new_members(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Symbols of the latest snapshot that the one before did not have."""
    return snapshot_diff(snapshots, as_of).filter(F.col("status") == "added").select("symbol")


# --- membership through time -----------------------------------------------------

def _state() -> Column:
    return F.struct("present", *ATTRIBUTES)


def membership_intervals(snapshots: DataFrame) -> DataFrame:
    """symbol, attributes, valid_from, valid_to: each stretch of unbroken membership with
    unchanged attributes, from its first snapshot up to, and without, the snapshot that
    ends it. `valid_to` is null while the newest snapshot still has it.

    A later snapshot closes open stretches and begins new ones; it changes no other row.
    Rows without symbol or time belong to none; of a symbol that a snapshot has twice the
    smallest attributes count. A symbol has a row per snapshot at most, and looks back by
    pieces of time, so one with much of the table is no burden.
    """
    rows = snapshots.filter(F.col("symbol").isNotNull() & F.col("updated_at").isNotNull())
    times = rows.select(F.lit(0).alias("all"), "updated_at").distinct()
    following = with_previous(times.withColumn("run", F.col("updated_at")), "all",
                              "updated_at", ["run"]).select(
        F.col("previous_run").alias("updated_at"), F.col("run").alias("next_run")).filter(
        "updated_at IS NOT NULL")
    order = [c for a in ATTRIBUTES for c in (F.col(a).isNull().alias(f"no_{a}"), F.col(a))]
    least = F.min(F.struct(*order))
    present = rows.groupBy("symbol", "updated_at").agg(
        *[least[a].alias(a) for a in ATTRIBUTES]).withColumn("present", F.lit(True))
    # A member of one snapshot is absent from the next, unless that one has it.
    absent = present.join(broadcast_if_fits(following), "updated_at").select(
        "symbol", F.col("next_run").alias("updated_at"),
        *[F.lit(None).cast("string").alias(a) for a in ATTRIBUTES],
        F.lit(False).alias("present"))
    states = present.unionByName(absent).groupBy("symbol", "updated_at").agg(
        F.max(_state()).alias("state"))
    changes = with_previous(states, "symbol", "updated_at", ["state"]).filter(
        ~F.col("state").eqNullSafe(F.col("previous_state")))
    by_symbol = Window.partitionBy("symbol").orderBy("updated_at")
    return (
        changes.withColumn("valid_to", F.lead("updated_at").over(by_symbol))
        .filter("state.present")
        .select("symbol", *[F.col(f"state.{a}") for a in ATTRIBUTES],
                F.col("updated_at").alias("valid_from"), "valid_to")
    )


def extend_intervals(intervals: DataFrame, snapshots: DataFrame,
                     last_run: datetime) -> DataFrame:
    """`intervals`, built from all snapshots up to `last_run`, brought up to the later ones.

    Reads only the open rows and the snapshots after `last_run`; older ones among
    `snapshots` are passed over. The result equals a build from all snapshots.
    """
    moment = at(last_run, intervals.schema["valid_from"].dataType)
    later = snapshots.filter(
        F.col("updated_at") > at(last_run, snapshots.schema["updated_at"].dataType))
    is_open = F.col("valid_to").isNull()
    carried = intervals.filter(is_open).select(
        "symbol", *ATTRIBUTES, moment.alias("updated_at"))
    begun = intervals.filter(is_open).select("symbol", F.col("valid_from").alias("begun"))
    built = membership_intervals(
        carried.unionByName(later.select("symbol", *ATTRIBUTES, "updated_at")))
    return intervals.filter(~is_open).unionByName(
        built.join(begun, (built["symbol"] == begun["symbol"]) & (built["valid_from"] == moment),
                   "left").select(
            built["symbol"], *ATTRIBUTES, F.coalesce("begun", "valid_from").alias("valid_from"),
            "valid_to"))


def members_as_of(intervals: DataFrame, as_of: datetime) -> DataFrame:
    """Members and their attributes at one time, under report names; a filter, no shuffle."""
    moment = at(as_of, intervals.schema["valid_from"].dataType)
    inside = (F.col("valid_from") <= moment) & (
        F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    return _reported(intervals.filter(inside))


def companies_as_of(intervals: DataFrame, as_of: datetime) -> DataFrame:
    """Newest attributes of every symbol seen until `as_of`, leavers too; as
    `latest_company` gives them from the snapshots."""
    seen = intervals.filter(until(intervals, as_of, "valid_from"))
    newest = F.max_by(F.struct(*ATTRIBUTES), "valid_from").alias("newest")
    return _reported(seen.groupBy("symbol").agg(newest).select("symbol", "newest.*"))
