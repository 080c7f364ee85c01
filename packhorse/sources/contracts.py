"""Declared schemas, and the check of a table against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from packhorse.functions.columns import quoted, text

_INT, _BIGINT, _DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
_STRING, _TIME = T.StringType(), T.TimestampNTZType()


def required(**columns: T.DataType) -> T.StructType:
    """A schema whose columns must not be null."""
    return T.StructType([T.StructField(name, kind, False) for name, kind in columns.items()])


# The declared schemas of the given tables.
CONTRACTS: dict[str, T.StructType] = {
    "region": required(r_regionkey=_INT, r_name=_STRING),
    "nation": required(n_nationkey=_INT, n_name=_STRING, n_regionkey=_INT),
    "customer": required(
        c_custkey=_BIGINT,
        c_name=_STRING,
        c_nationkey=_INT,
        c_acctbal=_DOUBLE,
        c_mktsegment=_STRING,
    ),
    "supplier": required(
        s_suppkey=_BIGINT, s_name=_STRING, s_nationkey=_INT, s_acctbal=_DOUBLE
    ),
    "part": required(
        p_partkey=_BIGINT,
        p_name=_STRING,
        p_brand=_STRING,
        p_type=_STRING,
        p_size=_INT,
        p_retailprice=_DOUBLE,
    ),
    "orders": required(
        o_orderkey=_BIGINT,
        o_custkey=_BIGINT,
        o_orderstatus=_STRING,
        o_totalprice=_DOUBLE,
        o_orderdate=_TIME,
        o_orderpriority=_STRING,
    ),
    "lineitem": required(
        l_orderkey=_BIGINT,
        l_partkey=_BIGINT,
        l_suppkey=_BIGINT,
        l_linenumber=_INT,
        l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE,
        l_discount=_DOUBLE,
        l_tax=_DOUBLE,
        l_returnflag=_STRING,
        l_linestatus=_STRING,
        l_shipdate=_TIME,
    ),
    "events": required(
        event_id=_BIGINT,
        ts=_TIME,
        user_id=_BIGINT,
        event_type=_STRING,
        value=_DOUBLE,
        props=_STRING,
    ),
    "documents": required(
        doc_id=_BIGINT, text=_STRING, lang=_STRING, source=_STRING, n_chars=_BIGINT
    ),
    "labels": required(doc_id=_BIGINT, quality=_INT, toxic=_INT),
    "embeddings": required(vec_id=_BIGINT, embedding=T.ArrayType(T.FloatType()), label=_INT),
    "pages": required(page_id=_BIGINT, url=_STRING, html=_STRING),
    "benchmark": required(item_id=_BIGINT, text=_STRING),
    "conversations": required(conv_id=_BIGINT, turn=_BIGINT, role=_STRING, text=_STRING),
}


class ContractError(ValueError):
    """A table lacks declared columns or has them in another type."""


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read one Parquet table, refusing it when its schema breaks the contract."""
    df = spark.read.parquet(table_path(folder, name))
    return enforce_contract(df, CONTRACTS[name], name)


def _status(declared: T.StructField | None, actual: T.StructField | None) -> str:
    if actual is None:
        return "missing"
    if declared is None:
        return "extra"
    return "ok" if declared.dataType == actual.dataType else "mistyped"


def _pairs(
    df: DataFrame, contract: T.StructType
) -> list[tuple[str, T.StructField | None, T.StructField | None]]:
    declared = {field.name: field for field in contract.fields}
    actual = {field.name: field for field in df.schema.fields}
    names = [*declared, *(name for name in actual if name not in declared)]
    return [(name, declared.get(name), actual.get(name)) for name in names]


def enforce_contract(df: DataFrame, contract: T.StructType, name: str = "table") -> DataFrame:
    """The declared columns in declared order; extra columns are dropped.

    The check reads the schema only and starts no job.
    """
    broken = [
        f"{column} {status}"
        for column, declared, actual in _pairs(df, contract)
        if (status := _status(declared, actual)) in ("missing", "mistyped")
    ]
    if broken:
        raise ContractError(f"{name}: {', '.join(broken)}")
    return df.select(*contract.fieldNames())


def check_contract(df: DataFrame, contract: T.StructType, name: str = "table") -> DataFrame:
    """One row per declared or found column: both types, status, rows and nulls.

    `n_nulls` counts nulls in columns declared `not null`, and is 0 for others.
    All counts come from one aggregate, so the table is read once.
    """
    pairs = _pairs(df, contract)
    counts, lines = ["count(*) AS rows"], []
    for i, (column, declared, actual) in enumerate(pairs):
        status, nulls = text(_status(declared, actual)), "0L"
        if actual is not None and declared is not None and not declared.nullable:
            nulls = f"nulls_{i}"
            counts.append(f"count_if({quoted(column)} IS NULL) AS {nulls}")
        kinds = [field.dataType.simpleString() if field else "" for field in (declared, actual)]
        lines.append(
            f"{text(name)}, {text(column)}, {text(kinds[0])}, {text(kinds[1])}, "
            f"if({status} = 'ok' AND {nulls} > 0, 'nulls', {status}), rows, {nulls}"
        )
    # Expressions as SQL: one call for a wide table instead of hundreds.
    return df.selectExpr(*counts).selectExpr(
        f"stack({len(lines)}, {', '.join(lines)}) AS (table_name, column_name, "
        "declared_type, actual_type, status, n_rows, n_nulls)"
    )
