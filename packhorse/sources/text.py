"""CSV and JSON lines with a quarantine for malformed rows.

Lines are read as text and parsed by `from_csv` / `from_json`. Unlike the file
readers, this keeps the raw line and its file, and what counts as malformed
does not change with the columns a later step selects. CSV records may also span
lines; the file is still read in splits.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.parsing import with_csv, with_json
from packhorse.operators.ordered import CHUNK, LastKnown, Next, Parts, Position, RunningTotal, measure
from packhorse.session import scratch_path

_ADDED = ("raw", "file", "is_malformed")
# Lines that one record may span.
MOST_LINES = 1000


def _check(schema: T.StructType) -> None:
    clash = [name for name in schema.fieldNames() if name.lower() in _ADDED]
    if clash:
        raise ValueError(f"columns are added under these names: {', '.join(clash)}")


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Malformed: what does not parse as a whole, blank lines, and lines without a required field."""
    present = [F.col("row").getField(f.name).isNotNull() for f in schema.fields if not f.nullable]
    good = reduce(and_, present, F.col("is_whole") & (F.trim("raw", F.lit(" \t\r")) != ""))
    return lines.select(
        "raw", "file", *[F.col("row").getField(f.name).alias(f.name) for f in schema.fields],
        (~F.coalesce(good, F.lit(False))).alias("is_malformed"),
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file")
    )


def read_csv_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed columns plus `raw`, `file` and `is_malformed`, one row per line.

    A line with missing or surplus fields, a field that does not parse as its
    declared type, a quote that is not closed, or nothing in a field that `schema`
    declares not null is malformed, and so is a blank line. Lines equal to `header`
    are not data. Every line is parsed once, whatever is selected later.
    """
    _check(schema)
    lines = _lines(spark, path)
    if header is not None:
        lines = lines.filter(F.col("raw") != header)
    return _parsed(with_csv(lines, "raw", schema, "row", "is_whole", options), schema)


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """As `read_csv_lines`, for one JSON object per line; text behind the object is malformed."""
    _check(schema)
    return _parsed(with_json(_lines(spark, path), "raw", schema, "row", "is_whole", options), schema)


def _quotes(raw: Column, options: Mapping[str, str] | None) -> Column:
    """How many quotes of a line open or close a field."""
    given = {name.lower(): value for name, value in (options or {}).items()}
    quote, escape = given.get("quote", '"'), given.get("escape", "\\")
    if escape != quote:
        # An escaped character is not looked at.
        raw = F.regexp_replace(raw, "\\Q" + escape + "\\E.", "")
    return F.length(raw) - F.length(F.replace(raw, F.lit(quote), F.lit("")))


def csv_records(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None, most_lines: int = MOST_LINES
) -> DataFrame:
    """`raw`, `file` and `is_torn` of each CSV record, which may span lines in quoted fields.

    The file is read in splits. A line begins a record if an even number of quotes
    stands before it in its file, which takes one running total within each
    split and one over the splits; so a record may begin in one and end in
    another. Quotes may only stand at the ends of quoted fields, or escaped. A record
    that goes on for more than `most_lines` lines, as behind a quote that is
    never closed, is torn: its first lines are one row, each of the others is a
    row of its own.
    """
    split = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias(CHUNK), F.monotonically_increasing_id().alias("line"),
    ).withColumn("quotes", _quotes(F.col("raw"), options))
    keys, order = ["file"], ["line"]
    parts = Parts(split.limit(0).drop(CHUNK), split)
    parts = measure(parts, keys, order, {"until": RunningTotal(F.col("quotes")), "place": Position()})
    begins = (F.col("until") - F.col("quotes")) % 2 == 0
    parts = parts.map(lambda rows: rows.withColumn("begin", F.when(begins, F.col("place"))))
    parts = measure(parts, keys, order, {"earlier": LastKnown(F.col("begin")), "then": Next(F.col("begin"))})
    path = scratch_path(spark, "records")
    (
        parts.large.select(
            "raw", "file", "place", F.coalesce("begin", "earlier").alias("record"),
            # Lines of which the next is another record's; the last line has no next.
            (F.col("begin").isNotNull() & (F.col("then").isNotNull() | (F.col("until") % 2 == 0))).alias("alone"),
        ).write.parquet(path)
    )
    lines = spark.read.parquet(path)
    index = F.col("place") - F.col("record")
    whole = lines.filter("alone").select("raw", "file", F.lit(False).alias("is_torn"))
    # At most so many lines of a record meet in a group.
    joined = (
        lines.filter(~F.col("alone") & (index < most_lines)).groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("place", "raw"))).alias("lines"))
        .select(F.array_join("lines.raw", "\n").alias("raw"), "file", "record")
    )
    beyond = lines.filter(~F.col("alone") & (index >= most_lines))
    long = beyond.filter(index == most_lines).select("file", "record", F.lit(True).alias("is_torn"))
    joined = joined.join(long, ["file", "record"], "left").select("raw", "file", F.coalesce("is_torn", F.lit(False)).alias("is_torn"))
    rest = beyond.select("raw", "file", F.lit(True).alias("is_torn"))
    records = whole.unionByName(joined).unionByName(rest)
    # Line ends of two characters, which the split leaves one of.
    return records.withColumn("raw", F.regexp_replace("raw", "\r$", ""))


def read_csv_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: str | None = None,
    options: Mapping[str, str] | None = None,
    most_lines: int = MOST_LINES,
) -> DataFrame:
    """As `read_csv_lines`, one row per record, whose quoted fields may hold line breaks."""
    _check(schema)
    records = csv_records(spark, path, options, most_lines)
    if header is not None:
        records = records.filter(F.col("raw") != header)
    told = with_csv(records, "raw", schema, "row", "is_whole", options)
    return _parsed(told.withColumn("is_whole", F.col("is_whole") & ~F.col("is_torn")), schema)


def accepted(parsed: DataFrame) -> DataFrame:
    """The well-formed rows, typed."""
    return parsed.filter(~F.col("is_malformed")).drop("raw", "file", "is_malformed")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The malformed lines as they stand in the file, with the file's path."""
    return parsed.filter("is_malformed").select("raw", "file")
