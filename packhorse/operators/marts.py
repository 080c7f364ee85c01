"""Aggregate marts, subtotals, pivot and unpivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhorse.functions.columns import money

def revenue_mart(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame
) -> DataFrame:
    """Revenue and number of lines by the customer's nation and order month.

    Lines are summed per order before any join, in the map tasks first, and the
    join on the order key reuses that partitioning: the largest table is
    shuffled once, and an order with very many lines is one row by then.
    """
    price = money(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(price).alias("_revenue"), F.count(F.lit(1)).alias("_lines")
    )
    buyer = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "n_name"
    )
    placed = orders.join(buyer, orders.o_custkey == buyer.c_custkey).select(
        "o_orderkey",
        F.col("n_name").alias("nation"),
        # As text, because date_format would go through the session's time zone.
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("order_month"),
    )
    return (
        per_order.join(placed, per_order.l_orderkey == placed.o_orderkey)
        .groupBy("nation", "order_month")
        .agg(
            F.sum("_revenue").cast("double").alias("revenue"),
            F.sum("_lines").alias("n_lines"),
        )
    )


# Kinds of measure that can be put together from parts: how rows are first
# aggregated, and how the parts are.
_OF_ROWS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_OF_PARTS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def finest(
    df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """P10: the measures at the finest level of the dimensions.

    `measures` maps a name to a kind (sum, count, min, max) and a column.
    """
    return df.groupBy(*dimensions).agg(
        *[_OF_ROWS[kind](column).alias(name) for name, (kind, column) in measures.items()]
    )


def subtotals(
    fine: DataFrame, dimensions: Sequence[str], kinds: Mapping[str, str], mode: str = "rollup"
) -> DataFrame:
    """P10: `rollup` or `cube` over the rows of `finest`, with `level` as grouping id.

    Only these groups are repeated per level, instead of every input row. Names
    for the dimensions can be joined in between, on few rows.
    """
    grouped = {"rollup": fine.rollup, "cube": fine.cube}[mode](*dimensions)
    return grouped.agg(
        F.grouping_id().alias("level"),
        *[_OF_PARTS[kind](name).alias(name) for name, kind in kinds.items()],
    )


def pivot(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence[str],
    aggregate: Column,
    default: float | str | None = None,
    other: str | None = None,
) -> DataFrame:
    """One row per key and one `aggregate` per listed value of `column`.

    The values are given, so no job looks for them and the schema is fixed. Keys
    without a value have the default there, or null. Rows with a null or with a
    value that is not listed go into the column `other`; without one they count
    for nothing but their key.
    """
    names = list(values)
    if other is not None:
        listed = F.coalesce(F.col(column).isin(names), F.lit(False))
        df = df.withColumn(column, F.when(listed, F.col(column)).otherwise(F.lit(other)))
        names.append(other)
    wide = df.groupBy(*keys).pivot(column, names).agg(aggregate)
    return wide if default is None else wide.fillna(default, subset=names)


def unpivot(
    wide: DataFrame, keys: Sequence[str], values: Sequence[str], column: str, value: str
) -> DataFrame:
    """The inverse; one row per key and listed value, from rows in place."""
    return wide.unpivot(list(keys), list(values), column, value)
