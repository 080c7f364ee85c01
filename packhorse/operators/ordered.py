"""Ordered windows per key that stay parallel when one key is very large.

A plain window puts all rows of a key into one task. `scan` does that only for
keys that fit. The rows of larger keys are range-partitioned along the window's
own order into chunks: the window runs within each chunk, every chunk is summed
up to one row, and what a chunk needs from the chunks before (or after) it is
added from those few rows. The result is the same for any cut.

Where no key is large this is the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import all_of
from packhorse.functions.skew import ROWS_PER_TASK, large_keys, split
from packhorse.session import delete_scratch, scratch_path, stored

CHUNK = "_chunk"
# Tasks that chunks are written in: one each, until there are more chunks than this.
CHUNK_TASKS = 200


@dataclass(frozen=True)
class Measure:
    """A window value over `value`, which is an expression on the input rows."""

    value: Column

    def check(self, df: DataFrame) -> None:
        """Raise an error if the value cannot be measured."""

    def whole(self, w: WindowSpec, order: Column) -> Column:
        """The value where a key lies in one piece."""
        return self.within(w, order)

    def within(self, w: WindowSpec, order: Column) -> Column:
        """The value as far as one chunk alone can tell it."""
        raise NotImplementedError

    def summary(self, order: Column) -> Column:
        """The aggregate that one chunk passes on to the others."""
        raise NotImplementedError

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        """What the other chunks' summaries mean for a chunk."""
        raise NotImplementedError

    def join(self, within: Column, carry: Column) -> Column:
        raise NotImplementedError


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


class RunningTotal(Measure):
    """Sum up to and with the current row.

    Floating-point values are refused: their sums depend on where a key is cut.
    """

    def check(self, df: DataFrame) -> None:
        kind = df.select(self.value.alias("v")).schema["v"].dataType
        if isinstance(kind, T.FloatType | T.DoubleType):
            raise TypeError(f"a running total of {kind.simpleString()} is not exact; cast it to a decimal")

    def within(self, w: WindowSpec, order: Column) -> Column:
        return F.sum(self.value).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, order: Column) -> Column:
        return F.sum(self.value)

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        return F.sum(summary).over(_before(w))

    def join(self, within: Column, carry: Column) -> Column:
        return F.coalesce(within + carry, within, carry)


class Position(RunningTotal):
    """Row number, from 1."""

    def __init__(self) -> None:
        super().__init__(F.lit(1).cast("bigint"))


class Previous(Measure):
    """The value of the row before; null for a key's first row."""

    def whole(self, w: WindowSpec, order: Column) -> Column:
        return F.lag(self.value).over(w)

    def within(self, w: WindowSpec, order: Column) -> Column:
        # Wrapped, so that a null value differs from there being no row before.
        return F.lag(F.struct(self.value.alias("v"))).over(w)

    def summary(self, order: Column) -> Column:
        return F.max_by(F.struct(self.value.alias("v")), order)

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        return F.lag(summary).over(w)

    def join(self, within: Column, carry: Column) -> Column:
        return F.coalesce(within, carry).getField("v")


class Next(Previous):
    """The value of the row after; null for a key's last row."""

    def whole(self, w: WindowSpec, order: Column) -> Column:
        return F.lead(self.value).over(w)

    def within(self, w: WindowSpec, order: Column) -> Column:
        return F.lead(F.struct(self.value.alias("v"))).over(w)

    def summary(self, order: Column) -> Column:
        return F.min_by(F.struct(self.value.alias("v")), order)

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        return F.lead(summary).over(w)


class LastKnown(Measure):
    """The latest non-null value in the rows before the current one."""

    def within(self, w: WindowSpec, order: Column) -> Column:
        return F.last(self.value, ignorenulls=True).over(_before(w))

    def summary(self, order: Column) -> Column:
        return F.max_by(self.value, F.when(self.value.isNotNull(), order))

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        return F.last(summary, ignorenulls=True).over(_before(w))

    def join(self, within: Column, carry: Column) -> Column:
        return F.coalesce(within, carry)


def _chunk_tasks(n: int, rows_per_task: int) -> int:
    """How many tasks write `n` chunks: few, unless one would take more than `ROWS_PER_TASK` rows."""
    return min(n, max(CHUNK_TASKS, n * rows_per_task // ROWS_PER_TASK))


def _chunks(df: DataFrame, columns: Sequence[str | Column], n: int, rows_per_task: int) -> DataFrame:
    """Range-partition by `columns` and store each row's chunk: its partition, or a part of it.

    Every partition sends samples for the bounds and a result to the driver, so
    small chunks are not one partition each: beyond `CHUNK_TASKS`, partitions are
    sorted and cut every `rows_per_task` rows.

    The table is written because range bounds are sampled anew in every plan;
    read back, both uses below and all task retries see the same chunks. The rows
    are written as they are first, so that the sampling of the bounds does not
    evaluate the input again; that copy is deleted once the chunks are there.
    """
    spark = df.sparkSession
    rows, path = scratch_path(spark, "large"), scratch_path(spark, "chunks")
    df.write.parquet(rows)
    tasks = _chunk_tasks(n, rows_per_task)
    dealt, chunk = spark.read.schema(df.schema).parquet(rows).repartitionByRange(tasks, *columns), F.spark_partition_id()
    if tasks < n:
        # The partition is above the lower 33 bits, the row's place in it in them.
        dealt, number = dealt.sortWithinPartitions(*columns), F.monotonically_increasing_id()
        chunk = number - number.bitwiseAND(F.lit((1 << 33) - 1)) % rows_per_task
    dealt.withColumn(CHUNK, chunk).write.parquet(path)
    delete_scratch(spark, rows)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Parts:
    """The rows of small keys, and those of large keys, if any, with their chunk."""

    small: DataFrame
    large: DataFrame | None

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Parts:
        """Apply a step that works on single rows to both."""
        return Parts(step(self.small), None if self.large is None else step(self.large))

    def union(self) -> DataFrame:
        if self.large is None:
            return self.small
        return self.small.unionByName(self.large.drop(CHUNK))


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    rows_per_task: int | None,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Parts:
    """Cut the rows of large keys into chunks along `order`.

    Looking for large keys costs a pass over the key columns; `None` spares it
    where the rows per key are known to be few. With large keys `df` is
    evaluated three times in all: for the sample, for the rows of small keys, and
    once to store those of large keys. `prepare` is applied after that, to
    the rows of small and of large keys; it may only make rows fewer.
    """
    large = None if rows_per_task is None else large_keys(df, keys, rows_per_task)
    if large is None:
        return Parts(prepare(df), None)
    rest, hot = split(df, large, keys)
    return Parts(prepare(rest), _chunks(prepare(hot), [*keys, *order], large.tasks, rows_per_task))


def measure(
    parts: Parts, keys: Sequence[str], order: Sequence[str], measures: Mapping[str, Measure]
) -> Parts:
    """Add `measures` over the rows of each key in ascending `order`.

    May be used again on its own result, also after rows were dropped: chunks
    stay in order.
    """
    for one in measures.values():
        one.check(parts.small)
    at = F.struct(*order)
    w = Window.partitionBy(*keys).orderBy(*order)
    small = parts.small.withColumns({name: m.whole(w, at) for name, m in measures.items()})
    if parts.large is None:
        return Parts(small, None)

    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    within = parts.large.withColumns(
        {f"_in_{name}": m.within(in_chunk, at) for name, m in measures.items()}
    )
    # One row per chunk and large key: no more than there are chunks and keys. A
    # row may be wide, so Spark decides by the stored size whether to broadcast.
    carried = stored(
        parts.large.groupBy(*keys, CHUNK)
        .agg(*[m.summary(at).alias(f"_sum_{name}") for name, m in measures.items()])
        .select(
            *[F.col(key).alias(f"_of_{key}") for key in keys],
            F.col(CHUNK).alias("_of_chunk"),
            *[
                m.carry(F.col(f"_sum_{name}"), across).alias(f"_out_{name}")
                for name, m in measures.items()
            ],
        ),
        "carried",
    )
    same = all_of(
        [F.col(CHUNK) == F.col("_of_chunk")]
        + [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    )
    large = within.join(carried, same, "left").select(
        *[F.col(f"`{c}`") for c in parts.large.columns],
        *[
            m.join(F.col(f"_in_{name}"), F.col(f"_out_{name}"))
            .cast(small.schema[name].dataType).alias(name)
            for name, m in measures.items()
        ],
    )
    return Parts(small, large)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """`cut` and `measure` in one step.

    `order` has to be unique within a key. All measures share one shuffle and
    one sort.
    """
    return measure(cut(df, keys, order, rows_per_task), keys, order, measures).union()


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add `position`, `running_total` and `previous_value` of `value` per key."""
    measures = {
        "position": Position(),
        "running_total": RunningTotal(value),
        "previous_value": Previous(value),
    }
    return scan(df, keys, order, measures, rows_per_task)


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """The first `k` rows per key in `order`, which has to be unique per key.

    Spark keeps `k` rows per key in each map task before the shuffle, so a
    large key sends few rows. Beyond
    `spark.sql.optimizer.windowGroupLimitThreshold` (1000) rows it does not; then
    the rows of large keys are cut into chunks along `order`. One count per chunk
    tells which chunks hold the first `k`, and only these are sorted. Columns may be
    of any type.
    """
    w = Window.partitionBy(*keys).orderBy(*order)

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)

    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if not k > limit >= 0:
        return first(df)
    parts = cut(df, keys, order, rows_per_task)
    if parts.large is None:
        return first(df)
    return first(parts.small).unionByName(_first_chunks(parts.large, keys, order, k, rank))


def _first_chunks(large: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk and large key.
    counted = large.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    starts = stored(
        counted.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter(F.col("_start") < k)
        .select(*[F.col(key).alias(f"_of_{key}") for key in keys], F.col(CHUNK).alias("_of_chunk"), "_start"),
        "first-chunks",
    )
    same = all_of(
        [F.col(CHUNK) == F.col("_of_chunk")]
        + [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    )
    within = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    place = (F.col("_start") + F.row_number().over(within)).cast("int")
    kept = [F.col(f"`{c}`") for c in large.columns if c != CHUNK]
    return large.join(starts, same).select(*kept, place.alias(rank)).filter(F.col(rank) <= k)


def top_ranks(
    df: DataFrame, keys: Sequence[str], value: str, k: int, rank: str = "rank"
) -> DataFrame:
    """All rows whose `value` has a rank of at most `k` in its key, greatest first.

    Rows with equal values share a rank, so there can be very many of them. They
    stay where they are: the at most `k` ranked values per key are found with
    `top_k` and joined to the rows. Null values are not ranked.
    """
    present = df.filter(F.col(value).isNotNull())
    greatest_first = Window.partitionBy(*keys).orderBy(F.desc(value))
    levels = (
        top_k(present.select(*keys, value), keys, [F.desc(value)], k, "_row")
        .withColumn(rank, F.rank().over(greatest_first))
        .select(
            *[F.col(key).alias(f"_of_{key}") for key in keys], F.col(value).alias("_level"), rank
        )
        .distinct()
    )
    same = all_of(
        [F.col(value) == F.col("_level")]
        + [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    )
    return present.join(levels, same).select(*[F.col(f"`{c}`") for c in df.columns], rank)
