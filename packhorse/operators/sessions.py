"""P20: sessions of activity, closed by a gap without any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhorse.operators.ordered import Previous, RunningTotal, cut, measure


def sessionise(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    gap_seconds: int,
    value: Column,
    rows_per_task: int | None = None,
) -> DataFrame:
    """One row per session: first and last time, number of events, total of `value`.

    A session goes on while the next event is at most `gap_seconds` later.
    Events of a key that fall into the same slot of `gap_seconds` are never
    further apart than that, so they are summed up per slot in the map tasks.
    What is then ordered per key is bounded by the time covered over the gap,
    not by the number of events; give `rows_per_task` where that is still too
    much for a task. `value` should be a decimal. Rows without a time are left
    out.
    """
    slot = F.window(at, f"{gap_seconds} seconds")

    def by_slot(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, slot.getField("start").alias("_slot")).agg(
            F.min(at).alias("_first"),
            F.max(at).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(value).alias("_value"),
        )

    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    opens = F.coalesce(F.col("_first") > F.col("_before") + gap, F.lit(True)).cast("bigint")
    parts = cut(df, keys, ["_slot"], rows_per_task, by_slot)
    parts = measure(parts, keys, ["_slot"], {"_before": Previous(F.col("_last"))})
    numbered = measure(parts, keys, ["_slot"], {"_session": RunningTotal(opens)}).union()
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_n").alias("n_events"),
            F.sum("_value").alias("total_value"),
        )
        .drop("_session")
    )
