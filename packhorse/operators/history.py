"""Versions over time, and look-ups as of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhorse.functions.skew import ROWS_PER_TASK
from packhorse.operators.ordered import LastKnown, Next, Previous, cut, measure, scan


def type2_history(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    tie_break: str,
    track: Sequence[str] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add `valid_from`, `valid_to` and `is_current` to the versions of a key.

    `valid_to` is the time of the next version and null for the current one.
    With `track`, a row starts a version only if it is the key's first or
    differs from the row before in one of those columns.
    """
    order = [at, tie_break]
    parts = cut(df, keys, order, rows_per_task)
    if track is not None:
        state = F.struct(*track)
        parts = measure(parts, keys, order, {"_before": Previous(state)}).map(
            lambda rows: rows.filter(~F.col("_before").eqNullSafe(state)).drop("_before")
        )
    versions = measure(parts, keys, order, {"valid_to": Next(F.col(at))}).union()
    return versions.withColumns(
        {"valid_from": F.col(at), "is_current": F.col("valid_to").isNull()}
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_order: Sequence[str],
    right_order: Sequence[str],
    hit: str,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Every left row with the last earlier right row of its key.

    `left_order` and `right_order` name a time and a tie-break column on each
    side. Earlier means strictly earlier in time. The right row is added as the
    struct `hit`, null when there is none. As in an equi-join, a null in a key
    or a time is equal to nothing and earlier than nothing: such right rows are
    never a hit, and such left rows have none. Both sides go through one scan
    instead of a join, so the work is linear in the rows of a key.
    """
    right = right.dropna(subset=[*keys, right_order[0]])

    def lane(df: DataFrame, order: Sequence[str], is_right: int) -> DataFrame:
        time, tie = order
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return df.select(
            *[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)],
            F.col(time).alias("_at"),
            # At equal times left rows come first and do not see right rows.
            F.lit(is_right).alias("_lane"),
            F.col(tie).alias("_tie"),
            row.alias("_right" if is_right else "_left"),
        )

    both = lane(left, left_order, 0).unionByName(
        lane(right, right_order, 1), allowMissingColumns=True
    )
    at = [f"_k{i}" for i in range(len(keys))]
    found = scan(
        both, at, ["_at", "_lane", "_tie"], {hit: LastKnown(F.col("_right"))}, rows_per_task
    )
    return found.filter("_lane = 0").select("_left.*", hit)
