"""Operators on business keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhorse.functions.columns import all_of, quoted, unused
from packhorse.functions.digest import canonical, digest, holds_map
from packhorse.functions.skew import ROWS_PER_TASK, filter_join
from packhorse.operators.ordered import top_k
from packhorse.session import stored


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """The first row per key in the order `latest`, which has to be total.

    The group limit leaves one row per key and map task before the shuffle.
    """
    rank = unused("rank", df.columns)
    return top_k(df, keys, latest, 1, rank).drop(rank)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _by_parent(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str], how: str, rows_per_task: int | None
) -> DataFrame:
    # Distinct first: repeated parent keys collapse in the map tasks, and the
    # join reuses the partitioning of the distinct.
    names = {f"_parent_{p}": p for p in on.values()}
    parents = parent.select(*[F.col(p).alias(name) for name, p in names.items()]).distinct()
    same = all_of(F.col(c) == F.col(f"_parent_{p}") for c, p in on.items())
    return filter_join(child, parents, same, how, list(on), rows_per_task)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Child rows without a parent row; `on` maps child to parent columns.

    A row with a null in its key has no parent.
    """
    return _by_parent(child, parent, on, "left_anti", rows_per_task)


def matched(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Child rows with at least one parent row, each once."""
    return _by_parent(child, parent, on, "left_semi", rows_per_task)


def enrich(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]
) -> DataFrame:
    """Add dimension `columns` (found name to new name) to every fact row.

    The dimension must hold one row per key (see `guarded_enrich`). No hint is given: Spark broadcasts
    a dimension whose size is below `spark.sql.autoBroadcastJoinThreshold`, and
    shuffles a larger one, splitting partitions with a large fact key at run
    time.
    """
    side = dimension.select(
        *[F.col(d).alias(f"_dim_{d}") for d in on.values()],
        *[F.col(d).alias(new) for d, new in columns.items()],
    )
    same = all_of(F.col(f) == F.col(f"_dim_{d}") for f, d in on.items())
    return facts.join(side, same, "left").drop(*[f"_dim_{d}" for d in on.values()])


class Enriched(NamedTuple):
    """Facts with their dimension columns, and facts whose key the dimension holds more than once, as they were."""

    rows: DataFrame
    ambiguous: DataFrame


def guarded_enrich(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> Enriched:
    """`enrich` for a dimension that may repeat keys, which would multiply facts.

    Every fact is in one of the two tables, once. Repeated keys are counted in the
    map tasks first and written to the scratch folder, one short row each; facts
    of a large key are not shuffled to meet them.
    """
    names = {d: f"_twice_{d}" for d in on.values()}
    twice = stored(duplicated_keys(dimension, list(names)).drop("n_rows").withColumnsRenamed(names), "repeated-keys")
    of_fact = all_of(F.col(f) == F.col(names[d]) for f, d in on.items())
    of_dimension = all_of(F.col(d) == F.col(name) for d, name in names.items())
    clear = filter_join(facts, twice, of_fact, "left_anti", list(on), rows_per_task)
    ambiguous = filter_join(facts, twice, of_fact, "left_semi", list(on), rows_per_task)
    return Enriched(enrich(clear, dimension.join(twice, of_dimension, "left_anti"), on, columns), ambiguous)


def _changes(n: Column, in_old: Column, in_new: Column, same: Column) -> Column:
    return (
        F.when(n > 1, "duplicate").when(~in_old, "insert").when(~in_new, "delete")
        .when(same, "same").otherwise("update")
    )


def _fields(df: DataFrame, columns: Sequence[str], side: str) -> dict[str, Column]:
    """The canonical forms of a struct's fields, which can be compared."""
    return {name: canonical(F.col(side).getField(name), df.schema[name].dataType) for name in columns}


def _changed(df: DataFrame, columns: Sequence[str], change: Column) -> Column:
    """Names of the columns that an update changes."""
    old, new = _fields(df, columns, "old"), _fields(df, columns, "new")
    names = F.array_compact(F.array(*[F.when(~old[c].eqNullSafe(new[c]), F.lit(c)) for c in columns]))
    return F.when(change == "update", names).otherwise(F.array().cast("array<string>"))


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Per key `change`, the columns `changed`, and the values `old` and `new`.

    `change` is insert, update, delete or same, comparing `columns` null-safe; maps
    are equal if their entries are. A key with several rows in one snapshot is
    reported as duplicate, with the greatest of them. Grouping the two snapshots
    together, instead of joining them, takes one shuffle and turns such a key into
    two rows per map task where a join would pair all its rows. All values are
    shuffled and sorted; `snapshot_changes` spares that for rows that stay the same.
    """
    both = old.select(*keys, F.lit(True).alias("_is_old"), F.struct(*columns).alias("_row"))
    both = both.unionByName(
        new.select(*keys, F.lit(False).alias("_is_old"), F.struct(*columns).alias("_row"))
    )
    is_old, row = F.col("_is_old"), F.col("_row")
    maps = any(holds_map(old.schema[name].dataType) for name in columns)
    order = F.struct(*_fields(old, columns, "_row").values()) if maps else row

    def greatest(side: Column) -> Column:
        return F.max_by(row, F.when(side, order)) if maps else F.max(F.when(side, row))

    sides = both.groupBy(*keys).agg(
        greatest(is_old).alias("old"),
        greatest(~is_old).alias("new"),
        F.greatest(F.count_if(is_old), F.count_if(~is_old)).alias("_n"),
    )
    same = all_of(
        value.eqNullSafe(other)
        for value, other in zip(_fields(old, columns, "old").values(), _fields(old, columns, "new").values(), strict=True)
    )
    change = _changes(F.col("_n"), F.col("old").isNotNull(), F.col("new").isNotNull(), same)
    return sides.select(*keys, change.alias("change"), _changed(old, columns, change).alias("changed"), "old", "new")


def snapshot_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """`snapshot_diff` without the keys whose rows are the same.

    Rows are compared by digests of 16 bytes, grouped by hash, and only the keys
    with changes are joined to the values; Spark broadcasts them if they are few.
    A duplicate key has no values, as there are several. Equal but for different
    rows with equal digests.
    """
    def side(df: DataFrame, is_old: bool) -> DataFrame:
        first, second = digest([(F.col(quoted(c)), df.schema[c].dataType) for c in columns])
        return df.select(*keys, F.lit(is_old).alias("_is_old"), first.alias("_first"), second.alias("_second"))

    is_old = F.col("_is_old")
    both = side(old, True).unionByName(side(new, False))
    halves = [F.max(F.when(is_old, F.col(c))).eqNullSafe(F.max(F.when(~is_old, F.col(c)))) for c in ("_first", "_second")]
    n_old, n_new = F.count_if(is_old), F.count_if(~is_old)
    change = _changes(F.col("_n"), F.col("_in_old"), F.col("_in_new"), F.col("_same"))
    names = {f"_of_{key}": key for key in keys}
    told = both.groupBy(*keys).agg(
        F.greatest(n_old, n_new).alias("_n"), (n_old > 0).alias("_in_old"), (n_new > 0).alias("_in_new"),
        all_of(halves).alias("_same"),
    ).select(*[F.col(key).alias(name) for name, key in names.items()], change.alias("change")).filter("change != 'same'")

    def values(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(key).alias(f"_{name}_{key}") for key in keys], F.struct(*columns).alias(name))

    def joined(rows: DataFrame, df: DataFrame, name: str, kinds: Sequence[str]) -> DataFrame:
        # Keys of these kinds have one row in the snapshot.
        same = all_of(F.col(f"_of_{key}").eqNullSafe(F.col(f"_{name}_{key}")) for key in keys)
        return rows.join(values(df, name), same & F.col("change").isin(*kinds), "left")

    rows = joined(joined(told, old, "old", ("update", "delete")), new, "new", ("update", "insert"))
    return rows.select(
        *[F.col(name).alias(key) for name, key in names.items()], "change",
        _changed(old, columns, F.col("change")).alias("changed"), "old", "new",
    )
