"""Extract the rows after a stored high-water mark."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import unused


class Mark(NamedTuple):
    """The last row taken: its time and, among rows of that time, its id.

    Rows are in order by time, then id; a row without an id comes before those of
    its time that have one. Both values are kept as text with their types, so that
    they mean the same in any time zone of the Python process.
    """

    at: str
    type: str
    row_id: str | None
    id_type: str

    def time(self) -> Column:
        return F.lit(self.at).cast(self.type)

    def id(self) -> Column:
        value = F.lit(self.row_id)
        return F.unbase64(value) if self.id_type == "binary" else value.cast(self.id_type)


def _id_after(mark: Mark, row_id: str) -> Column:
    """Whether a row of the mark's time comes after it; never null."""
    if mark.row_id is None:
        return F.col(row_id).isNotNull()
    return F.coalesce(F.col(row_id) > mark.id(), F.lit(False))


def _after(mark: Mark, at: str, row_id: str) -> Column:
    # The bare comparison on the time is implied; it is what the scan can use.
    return (F.col(at) >= mark.time()) & ((F.col(at) > mark.time()) | _id_after(mark, row_id))


def _up_to(mark: Mark, at: str, row_id: str) -> Column:
    return (F.col(at) <= mark.time()) & ((F.col(at) < mark.time()) | ~_id_after(mark, row_id))


def highest_mark(df: DataFrame, at: str, row_id: str) -> Mark | None:
    """The mark of the last row, from one aggregate of the two columns."""
    kind = df.schema[row_id].dataType
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType | T.VariantType):
        raise TypeError(f"an id of type {kind.simpleString()} has no place in an order")
    dated = df.filter(F.col(at).isNotNull())
    top = dated.agg(F.max(F.struct(F.col(at).alias("at"), F.col(row_id).alias("id"))).alias("top"))
    as_text = F.base64("top.id") if isinstance(kind, T.BinaryType) else F.col("top.id").cast("string")
    last, number = top.select(F.col("top.at").cast("string"), as_text).first()
    return None if last is None else Mark(last, df.schema[at].dataType.simpleString(), number, kind.simpleString())


class Extract(NamedTuple):
    """Rows to load, rows without a time, the mark to store once they are loaded, and rows with a time but no id."""

    rows: DataFrame
    undated: DataFrame
    mark: Mark | None
    unnamed: DataFrame


def extract_after(
    df: DataFrame,
    at: str,
    row_id: str,
    mark: Mark | None,
    lookback: str | None = None,
    loaded: DataFrame | None = None,
) -> Extract:
    """The rows after `mark`, those without a time or an id apart, and the next mark.

    The new mark is taken first and limits the extract, so rows with a later
    time that arrive in between are left for the next run and none is taken
    twice. A row that arrives with a time before the mark is late: it is taken
    if its time is within `lookback` (an interval, as '2 days') before the mark
    and its id is not among those of `loaded`, the table that earlier runs
    filled; beyond `lookback`, or without one, it is not taken. Ids may be of any
    type that has an order. Rows with a time but no id are returned apart, each
    by the one run that its time falls in; nothing tells whether a late one was
    taken, so it is not. Rows without a time have no place before or after a mark:
    they are returned apart, by every run until `loaded` holds their ids, and by
    every run if they have none.
    """
    if (lookback is None) != (loaded is None):
        raise ValueError("lookback needs the loaded rows, so that none is taken twice")
    seen = unused("loaded", df.columns)

    def new_only(rows: DataFrame, ids: DataFrame) -> DataFrame:
        ids = ids.select(F.col(row_id).alias(seen))
        return rows.join(ids, F.col(row_id) == F.col(seen), "left_anti")

    undated = df.filter(F.col(at).isNull())
    fresh = df.filter(F.col(at).isNotNull() if mark is None else _after(mark, at, row_id))
    new = highest_mark(fresh, at, row_id) or mark
    if new is not None:
        fresh = fresh.filter(_up_to(new, at, row_id))
    unnamed, fresh = fresh.filter(F.col(row_id).isNull()), fresh.filter(F.col(row_id).isNotNull())
    if loaded is not None:
        undated = new_only(undated, loaded.filter(F.col(at).isNull()))
        if mark is not None:
            since = mark.time() - F.expr(f"INTERVAL {lookback}")
            late = df.filter((F.col(at) >= since) & _up_to(mark, at, row_id) & F.col(row_id).isNotNull())
            fresh = fresh.unionByName(new_only(late, loaded.filter(F.col(at) >= since)))
    return Extract(fresh, undated, new, unnamed)


def save_mark(spark: SparkSession, path: str, mark: Mark) -> None:
    """Append the mark; a failed run leaves the stored one in place."""
    row = spark.range(1).select(mark.time().alias("at"), mark.id().alias("row_id"))
    row.coalesce(1).write.mode("append").parquet(path)


def load_mark(spark: SparkSession, path: str) -> Mark | None:
    """The highest stored mark, or None before the first run."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return highest_mark(stored, "at", "row_id")
