"""Finding keys that hold more rows than one task should take."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhorse.functions.columns import all_of
from packhorse.session import scratch_path

ROWS_PER_TASK = 2_000_000
# A key counts as large when the sample holds this many of its rows.
LEAST_SAMPLES = 20
# Tables of large keys with no more rows than this are broadcast; others are
# joined by a shuffle if Spark finds them too large.
FEW_KEYS = 50_000


class LargeKeys(NamedTuple):
    keys: DataFrame
    # How many tasks the rows of all large keys should be spread over.
    tasks: int
    # Whether there are few enough keys to broadcast one row for each.
    few: bool


def sample_share(rows_per_task: int) -> float:
    """The share of rows to look at: the same for a table of any size."""
    return min(1.0, LEAST_SAMPLES / rows_per_task)


def least_samples(rows_per_task: int) -> int:
    """The sampled rows from which a key is large: what `rows_per_task` of its rows give on average."""
    return max(LEAST_SAMPLES, int(rows_per_task * sample_share(rows_per_task)))


def large_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> LargeKeys | None:
    """The keys that have clearly more rows than `rows_per_task`, from a sample; None if there are none.

    One pass over the key columns. The sample's counts are stored in the scratch
    folder, so that all tasks and retries see the same keys. The answer
    decides how work is spread, never what the result is.
    """
    least = least_samples(rows_per_task)
    sampled = (
        df.select(*keys).sample(sample_share(rows_per_task)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    )
    path = scratch_path(df.sparkSession, "large-keys")
    sampled.write.parquet(path)
    found = df.sparkSession.read.schema(sampled.schema).parquet(path)
    n_keys, n_rows = found.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not n_keys:
        return None
    return LargeKeys(found.drop("_n"), 1 + n_rows // least, n_keys <= FEW_KEYS)


def split(df: DataFrame, large: LargeKeys, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, rows of large keys; a null key is a key like any other."""
    names = {key: f"_large_{key}" for key in keys}
    few = hinted(large.keys.withColumnsRenamed(names), large)
    same = all_of(F.col(key).eqNullSafe(F.col(name)) for key, name in names.items())
    return df.join(few, same, "left_anti"), df.join(few, same, "left_semi")


def hinted(df: DataFrame, large: LargeKeys) -> DataFrame:
    """`df`, with one row per large key, broadcast if there are few of them."""
    return F.broadcast(df) if large.few else df


def filter_join(
    df: DataFrame,
    others: DataFrame,
    same: Column,
    how: str,
    keys: Sequence[str],
    rows_per_task: int | None,
) -> DataFrame:
    """A left_semi or left_anti join whose rows of large keys are not shuffled.

    `others` holds one row per key, under names of its own, and `same` compares
    them with the `keys` of `df`. Of the others, only those with a large key are
    needed for the rows of large keys: one row each, broadcast where the keys are.
    """
    large = None if rows_per_task is None else large_keys(df, keys, rows_per_task)
    if large is None:
        return df.join(others, same, how)
    rest, hot = split(df, large, keys)
    few = others.join(hinted(large.keys, large), same, "left_semi")
    return rest.join(others, same, how).unionByName(hot.join(hinted(few, large), same, how))
