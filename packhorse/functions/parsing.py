"""CSV and JSON text parsed once, with a mark behind it that tells whether the record is whole.

`from_csv` and `from_json` accept a record that the text goes on behind, and a
quoted field that is never closed. So a field, or a key, of a fixed name is put
behind the text: it is only found where the record ends with the text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What stands behind a record, and names that no schema has.
_END = "end-c1f7a9e2d04b4c6f"
_BAD = "malformed-c1f7a9e2d04b4c6f"
_RECORD = "record-c1f7a9e2d04b4c6f"


def _options(options: Mapping[str, str] | None) -> dict[str, str]:
    return {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}


def _nullable(schema: T.StructType) -> list[T.StructField]:
    # All nullable while parsing; what is required is checked afterwards.
    return [T.StructField(field.name, field.dataType) for field in schema.fields]


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def with_csv(
    df: DataFrame, raw: str, schema: T.StructType, out: str, is_whole: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """`df` with a struct `out` of the CSV record in `raw`, and `is_whole`: whether it is a record to its end.

    Columns with these two names are replaced.
    """
    given = {name.lower(): value for name, value in (options or {}).items()}
    sep = given.get("sep", given.get("delimiter", ","))
    fields = [*_nullable(schema), T.StructField(_END, T.StringType()), T.StructField(_BAD, T.StringType())]
    row = F.from_csv(F.concat(F.col(raw), F.lit(sep + _END)), _ddl(fields), _options(options))
    whole = (F.col(f"{out}.`{_END}`") == _END) & F.col(f"{out}.`{_BAD}`").isNull()
    record = F.struct(*[F.col(out).getField(f.name).alias(f.name) for f in schema.fields])
    return _told(df, row, out, record, is_whole, whole)


def with_json(
    df: DataFrame, raw: str, schema: T.StructType, out: str, is_whole: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """As `with_csv`, for one JSON object. Text that is no object gives a null struct."""
    record = T.StructField(_RECORD, T.StructType(_nullable(schema)))
    fields = [record, T.StructField(_END, T.IntegerType()), T.StructField(_BAD, T.StringType())]
    text = F.concat(F.lit(f'{{"{_RECORD}":'), F.col(raw), F.lit(f',"{_END}":1}}'))
    row = F.from_json(text, T.StructType(fields), _options(options))
    found = F.col(f"{out}.`{_RECORD}`")
    whole = (F.col(f"{out}.`{_END}`") == 1) & F.col(f"{out}.`{_BAD}`").isNull() & found.isNotNull()
    return _told(df, row, out, found, is_whole, whole)


def _told(df: DataFrame, row: Column, out: str, record: Column, is_whole: str, whole: Column) -> DataFrame:
    others = [F.col(f"`{name}`") for name in df.columns if name not in (out, is_whole)]
    # A generator over one element: the optimiser does not move what follows through
    # it, which would parse the text again for every field that a later step uses.
    parsed = df.select(*others, F.explode(F.array(row)).alias(out))
    return parsed.select(*others, record.alias(out), F.coalesce(whole, F.lit(False)).alias(is_whole))
