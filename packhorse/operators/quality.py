"""Validation, standardising, flattening and profiling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import all_of, failed_rules, quoted, text, unused
from packhorse.functions.digest import digest, is_plain
from packhorse.functions.parsing import with_json

FAILED = "failed_rules"


def valid_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows for which every rule holds; a rule that is null does not."""
    return df.filter(all_of(rules.values()))


def rejected_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The other rows, with the names of the rules that do not hold."""
    valid = F.coalesce(all_of(rules.values()), F.lit(False))
    return df.filter(~valid).withColumn(FAILED, failed_rules(rules))


def rule_summary(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the rows checked and failed, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"failed_{i}")
            for i, rule in enumerate(rules.values())
        ],
    )
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col("rows").alias("n_rows"),
            F.col(f"failed_{i}").alias("n_failed"),
        )
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class Field:
    """How one output column is made from one input column."""

    source: str
    name: str
    type: str = "string"
    case: str | None = None
    default: object = None

    def column(self, found: T.DataType) -> Column:
        value = F.col(self.source)
        if isinstance(found, T.StringType):
            value = F.nullif(F.trim(value), F.lit(""))
        if self.case is not None:
            value = {"upper": F.upper, "lower": F.lower, "title": F.initcap}[self.case](value)
        if self.type != found.simpleString():
            value = value.try_cast(self.type)
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default).cast(self.type))
        return value.alias(self.name)


def standardise(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Trim, blank to null, case, safe cast, default and rename.

    A value that does not fit its type becomes null, or the default.
    """
    return df.select(*[field.column(df.schema[field.source].dataType) for field in fields])


def flatten_json(
    df: DataFrame, column: str, schema: T.StructType, prefix: str = "", bad: str | None = None
) -> DataFrame:
    """P5: replace a JSON text column by typed columns.

    Text that is not one JSON object, or does not fit the schema, gives nulls for
    what does not. With `bad`, a column of that name holds such text, and null for
    all other rows; text behind the object counts as such. Columns of any name are
    kept, the text is parsed once.
    """
    others = [F.col(f"`{name}`") for name in df.columns if name != column]
    row, whole, raw = (unused(name, df.columns) for name in ("row", "is_whole", "raw"))
    parsed = with_json(df.withColumn(raw, F.col(f"`{column}`")), raw, schema, row, whole)
    kept = [] if bad is None else [F.when(~F.col(whole) & F.col(raw).isNotNull(), F.col(raw)).alias(bad)]
    fields = [F.col(row).getField(f.name).alias(f"{prefix}{f.name}") for f in schema.fields]
    return parsed.select(*others, *fields, *kept)


def profile(df: DataFrame) -> DataFrame:
    """Per column the rows, nulls, distinct values, least and greatest value.

    Rows, nulls and bounds take one pass without a shuffle of rows. Distinct
    values take a second one for all columns together: each row becomes a row per
    column with the value's digest of 16 bytes, and equal ones are merged in the
    map tasks first, so no long value is shuffled. Counts are exact but for equal
    digests of different values. Maps with equal entries are equal, at any depth,
    as are the two zeros. Least and greatest are given as text; types that are not
    plain have none.
    """
    counts, lines = ["count(*) AS rows"], []
    for i, field in enumerate(df.schema.fields):
        name = quoted(field.name)
        counts += [
            f"count_if({name} IS NULL) AS nulls_{i}",
            f"{_bound('min', field, name)} AS least_{i}",
            f"{_bound('max', field, name)} AS greatest_{i}",
        ]
        lines.append(f"{i}, {text(field.name)}, rows, nulls_{i}, least_{i}, greatest_{i}")
    whole = df.selectExpr(*counts).selectExpr(
        f"stack({len(lines)}, {', '.join(lines)}) AS (number, column_name, n_rows, n_nulls, least, greatest)"
    )
    # One row per column on both sides.
    found = whole.join(F.broadcast(_distinct(df)), "number", "left")
    return found.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("long"))).drop("number")


def _distinct(df: DataFrame) -> DataFrame:
    """Columns, by `number`, that have values, and how many different ones."""
    cells = []
    for i, field in enumerate(df.schema.fields):
        value = F.col(quoted(field.name))
        first, second = digest([(value, field.dataType)])
        cells.append(F.when(value.isNotNull(), F.struct(F.lit(i).alias("number"), first.alias("a"), second.alias("b"))))
    values = df.select(F.inline(F.array(*cells))).filter("number IS NOT NULL").distinct()
    return values.groupBy("number").agg(F.count(F.lit(1)).alias("n_distinct"))


def estimated_profile(df: DataFrame) -> DataFrame:
    """As `profile` with estimated distinct counts, in one pass without a shuffle of rows."""
    counts, lines = ["count(*) AS rows"], []
    for i, field in enumerate(df.schema.fields):
        name = quoted(field.name)
        counts += [
            f"count_if({name} IS NULL) AS nulls_{i}",
            f"{_bound('min', field, name)} AS least_{i}",
            f"{_bound('max', field, name)} AS greatest_{i}",
            f"approx_count_distinct({name}) AS distinct_{i}",
        ]
        lines.append(
            f"{text(field.name)}, rows, nulls_{i}, least_{i}, greatest_{i}, distinct_{i}"
        )
    names = "column_name, n_rows, n_nulls, least, greatest, n_distinct"
    return df.selectExpr(*counts).selectExpr(
        f"stack({len(lines)}, {', '.join(lines)}) AS ({names})"
    )


def _bound(end: str, field: T.StructField, value: str) -> str:
    if not is_plain(field.dataType):
        return "''"
    return f"coalesce(string({end}({value})), '')"
