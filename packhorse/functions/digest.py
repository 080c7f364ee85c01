"""Canonical forms and digests of values of any type.

Two values that are equal have one canonical form: the entries of maps are in
order, at any depth, and there is no negative zero. Canonical forms can be
compared and ordered, which maps can not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nested values are digested as JSON, with all that tells values apart.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def is_plain(kind: T.DataType) -> bool:
    return not isinstance(kind, T.ArrayType | T.MapType | T.StructType | T.VariantType)


def holds_map(kind: T.DataType) -> bool:
    """Whether values of the type can not be compared as they are."""
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, T.MapType | T.VariantType)


def canonical(value: Column, kind: T.DataType) -> Column:
    """The canonical form: a map becomes its entries in order, a variant its JSON."""
    if isinstance(kind, T.FloatType | T.DoubleType):
        return value + F.lit(0.0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: canonical(item, kind.elementType))
    if isinstance(kind, T.MapType):
        def entry(e: Column) -> Column:
            key, item = canonical(e.getField("key"), kind.keyType), canonical(e.getField("value"), kind.valueType)
            return F.struct(key.alias("key"), item.alias("value"))

        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(kind, T.StructType):
        fields = [canonical(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    return value


def _hashable(value: Column, kind: T.DataType) -> Column:
    """A plain value in place of any other: hash functions skip nulls and do not see where a nested value ends."""
    value = canonical(value, kind)
    return value if is_plain(kind) else F.to_json(F.struct(value.alias("v")), _JSON)


def digest(values: Sequence[tuple[Column, T.DataType]]) -> tuple[Column, Column]:
    """Two 64-bit digests of some values together, nulls among them: equal values have equal ones.

    They are of fixed width, so that Spark groups by hash whatever the values' types.
    """
    parts = []
    for value, kind in values:
        parts += [value.isNull(), _hashable(value, kind)]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)
