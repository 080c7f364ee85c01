"""P1 to P5 and P22 on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.operators.quality import (
    FAILED,
    Field,
    estimated_profile,
    flatten_json,
    profile,
    rejected_rows,
    rule_summary,
    standardise,
    valid_rows,
)
from packhorse.plans.registry import query
from packhorse.session import scratch_path
from packhorse.sources.contracts import CONTRACTS, check_contract, read_table, table_path
from packhorse.sources.text import accepted, quarantine, read_csv_lines, read_csv_records, read_json_lines

# P1

_SQL_TYPES = """
    CASE typeof(any_value({column}))
        WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
        WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
        WHEN 'FLOAT[]' THEN 'array<float>' ELSE typeof(any_value({column})) END
"""


def _contract_sql() -> str:
    lines = []
    for table, contract in CONTRACTS.items():
        for field in contract.fields:
            actual = _SQL_TYPES.format(column=field.name)
            lines.append(
                f"SELECT '{table}' AS table_name, '{field.name}' AS column_name, "
                f"'{field.dataType.simpleString()}' AS declared_type, {actual} AS actual_type, "
                f"CASE WHEN count(*) > count({field.name}) THEN 'nulls' ELSE 'ok' END AS status, "
                f"count(*) AS n_rows, count(*) - count({field.name}) AS n_nulls FROM {table}"
            )
    return "\nUNION ALL\n".join(lines)


@query(_contract_sql())
def p01_contract(spark: SparkSession, folder: str) -> DataFrame:
    reports = [
        check_contract(spark.read.parquet(table_path(folder, name)), contract, name)
        for name, contract in CONTRACTS.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query(
    """
    SELECT 'customer' AS table_name, v.*, c.n_rows, 0::BIGINT AS n_nulls
    FROM (SELECT count(*) AS n_rows FROM customer) c,
         (VALUES ('c_custkey', 'bigint', 'bigint', 'ok'),
                 ('c_name', 'string', 'string', 'ok'),
                 ('c_nationkey', 'int', 'int', 'ok'),
                 ('c_acctbal', 'decimal(12,2)', 'double', 'mistyped'),
                 ('c_phone', 'string', '', 'missing'),
                 ('c_mktsegment', '', 'string', 'extra')
         ) v(column_name, declared_type, actual_type, status)
    """
)
def p01_contract_drift(spark: SparkSession, folder: str) -> DataFrame:
    expected = T.StructType.fromDDL(
        "c_custkey bigint not null, c_name string not null, c_nationkey int not null, "
        "c_acctbal decimal(12,2) not null, c_phone string"
    )
    return check_contract(spark.read.parquet(table_path(folder, "customer")), expected, "customer")


# The orders as text, some of them damaged

_ORDERS = CONTRACTS["orders"]
_ORDER_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


def _as_text(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "price": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
            "date": F.col("o_orderdate").cast("string"),
        }
    )


def _kind(status: str, priority: str) -> Column:
    return (F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority)


def _csv_orders(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(_kind("P", "5-LOW"), "n/a").otherwise(F.col("price"))
    # concat_ws skips nulls, which cuts the last field off.
    priority = F.when(~_kind("O", "1-URGENT"), F.col("o_orderpriority"))
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", price, "date", priority)
    path = scratch_path(spark, "orders-csv")
    _as_text(read_table(spark, folder, "orders")).select(line.alias("value")).write.text(path)
    return read_csv_lines(spark, path, _ORDERS, options=_ORDER_OPTIONS)


def _json_orders(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(_kind("P", "3-MEDIUM"), '"n/a"').otherwise(F.col("price"))
    line = F.format_string(
        '{"o_orderkey":%d,"o_custkey":%d,"o_orderstatus":"%s","o_totalprice":%s,'
        '"o_orderdate":"%s","o_orderpriority":"%s"%s',
        "o_orderkey", "o_custkey", "o_orderstatus", price, "date", "o_orderpriority",
        F.when(_kind("F", "2-HIGH"), "").otherwise("}"),
    )
    path = scratch_path(spark, "orders-json")
    _as_text(read_table(spark, folder, "orders")).select(line.alias("value")).write.text(path)
    return read_json_lines(spark, path, _ORDERS, options=_ORDER_OPTIONS)


@query(
    """
    SELECT * FROM orders
    WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
      AND NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
    """
)
def p02_csv_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(_csv_orders(spark, folder))


@query(
    """
    SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN 'n/a'
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
        CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS raw
    FROM orders
    WHERE (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
       OR (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
    """
)
def p02_csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine(_csv_orders(spark, folder)).select("raw")


@query(
    """
    SELECT * FROM orders
    WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM')
      AND NOT (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')
    """
)
def p02_json_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(_json_orders(spark, folder))


@query(
    """
    SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
        || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":'
        || CASE WHEN o_orderstatus = 'P' THEN '"n/a"'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END
        || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        || '","o_orderpriority":"' || o_orderpriority || '"'
        || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '}' END AS raw
    FROM orders
    WHERE (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM')
       OR (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')
    """
)
def p02_json_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine(_json_orders(spark, folder)).select("raw")


# Fixed damage: the required priority is left empty, the required buyer left out, and lines are blank.


@query("SELECT * FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')")
def p02_csv_required(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.when(_kind("P", "5-LOW"), "").otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "price", "date", priority)
    lines = _as_text(read_table(spark, folder, "orders")).select(line.alias("value"))
    blank = lines.select(F.lit("  ").alias("value"))
    path = scratch_path(spark, "orders-csv")
    lines.unionByName(blank).write.text(path)
    return accepted(read_csv_lines(spark, path, _ORDERS, options=_ORDER_OPTIONS))


@query(
    """
    SELECT '{"o_orderkey":' || o_orderkey || '}' AS raw FROM orders WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT '' FROM orders WHERE o_orderpriority = '2-HIGH'
    """
)
def p02_json_required(spark: SparkSession, folder: str) -> DataFrame:
    low, blank = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "2-HIGH"
    whole = F.format_string(
        '{"o_orderkey":%d,"o_custkey":%d,"o_orderstatus":"%s","o_totalprice":%s,'
        '"o_orderdate":"%s","o_orderpriority":"%s"}',
        "o_orderkey", "o_custkey", "o_orderstatus", "price", "date", "o_orderpriority",
    )
    line = F.when(low, F.format_string('{"o_orderkey":%d}', "o_orderkey")).when(blank, "").otherwise(whole)
    path = scratch_path(spark, "orders-json")
    _as_text(read_table(spark, folder, "orders")).select(line.alias("value")).write.text(path)
    return quarantine(read_json_lines(spark, path, _ORDERS, options=_ORDER_OPTIONS)).select("raw")


# Fixed damage: a quote that is not closed, and text behind the object.


@query(
    """
    SELECT o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
        || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',"' || o_orderpriority AS raw
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT '{"k":' || o_orderkey || '} ' || o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """
)
def p02_torn_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that go on behind the record, or end within it."""
    orders = _as_text(read_table(spark, folder, "orders"))
    csv, json = scratch_path(spark, "orders-csv"), scratch_path(spark, "orders-json")
    torn, status = F.concat(F.lit('"'), "o_orderpriority"), F.col("o_orderstatus")
    priority = F.when(status == "P", torn).otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "price", "date", priority)
    orders.select(line.alias("value")).write.text(csv)
    behind = F.when(status == "F", F.concat(F.lit(" "), "o_orderpriority")).otherwise(F.lit("  "))
    orders.select(F.concat(F.format_string('{"k":%d}', "o_orderkey"), behind).alias("value")).write.text(json)
    keys = T.StructType.fromDDL("k bigint not null")
    of_csv = quarantine(read_csv_lines(spark, csv, _ORDERS, options=_ORDER_OPTIONS))
    return of_csv.unionByName(quarantine(read_json_lines(spark, json, keys))).select("raw")


_NOTES_SQL = """
    SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN o_orderpriority || chr(10) || '"' || o_orderkey || '", done' || chr(10) || chr(10)
        WHEN 'P' THEN o_orderpriority ELSE ', ' || chr(10) END AS note, o_totalprice
    FROM {orders}
"""


@query(_NOTES_SQL.format(orders="orders"))
def p02_csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """Notes with line breaks, quotes and commas, in a file that is read in splits."""
    notes = spark.sql(_NOTES_SQL, orders=read_table(spark, folder, "orders"))
    quoted = F.concat(F.lit('"'), F.replace(F.col("note"), F.lit('"'), F.lit('""')), F.lit('"'))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    path = scratch_path(spark, "notes-csv")
    notes.select(F.concat_ws(",", "o_orderkey", quoted, price).alias("value")).write.text(path)
    schema = T.StructType.fromDDL("o_orderkey bigint not null, note string, o_totalprice double")
    return accepted(read_csv_records(spark, path, schema, options={"escape": '"'}))


# P3



def line_rules() -> dict[str, Column]:
    return {
        "quantity_in_range": F.col("l_quantity").between(1, 45),
        "discount_in_range": F.col("l_discount").between(0.0, 0.08),
        "taxed": F.col("l_tax") > 0,
        "shipped_by_2001": F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz"),
        "returned_is_final": (F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F"),
    }


_RULES_SQL = """
    SELECT *,
        CASE WHEN l_quantity BETWEEN 1 AND 45 THEN NULL ELSE 'quantity_in_range' END AS r1,
        CASE WHEN l_discount BETWEEN 0.0 AND 0.08 THEN NULL ELSE 'discount_in_range' END AS r2,
        CASE WHEN l_tax > 0 THEN NULL ELSE 'taxed' END AS r3,
        CASE WHEN l_shipdate < TIMESTAMP '2001-01-01' THEN NULL ELSE 'shipped_by_2001' END AS r4,
        CASE WHEN l_returnflag <> 'R' OR l_linestatus = 'F' THEN NULL
             ELSE 'returned_is_final' END AS r5
    FROM lineitem
"""


@query(
    f"""
    SELECT * EXCLUDE (r1, r2, r3, r4, r5) FROM ({_RULES_SQL})
    WHERE coalesce(r1, r2, r3, r4, r5) IS NULL
    """
)
def p03_valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_rows(read_table(spark, folder, "lineitem"), line_rules())


@query(
    f"""
    SELECT * EXCLUDE (r1, r2, r3, r4, r5), concat_ws(',', r1, r2, r3, r4, r5) AS failed_rules
    FROM ({_RULES_SQL}) WHERE coalesce(r1, r2, r3, r4, r5) IS NOT NULL
    """
)
def p03_rejected(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rejected_rows(read_table(spark, folder, "lineitem"), line_rules())
    return rejected.withColumn(FAILED, F.array_join(FAILED, ","))


@query(
    f"""
    WITH checked AS ({_RULES_SQL})
    SELECT 'quantity_in_range' AS rule, count(*) AS n_rows, count(r1) AS n_failed FROM checked
    UNION ALL SELECT 'discount_in_range', count(*), count(r2) FROM checked
    UNION ALL SELECT 'taxed', count(*), count(r3) FROM checked
    UNION ALL SELECT 'shipped_by_2001', count(*), count(r4) FROM checked
    UNION ALL SELECT 'returned_is_final', count(*), count(r5) FROM checked
    """
)
def p03_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rule_summary(read_table(spark, folder, "lineitem"), line_rules())


# P4

CUSTOMER_FIELDS = [
    Field("c_custkey", "customer_id", "bigint"),
    Field("c_name", "customer_name", case="upper"),
    Field("c_nationkey", "nation_id", "int", default=-1),
    Field("c_acctbal", "balance", "double", default=0.0),
    Field("c_mktsegment", "segment", case="lower", default="unknown"),
]

PART_FIELDS = [
    Field("p_partkey", "part_id", "bigint"),
    Field("p_name", "part_name", case="title"),
    Field("brand_number", "brand_number", "int", default=-1),
    Field("p_type", "size_class", "int", default=0),
    Field("p_size", "size", "bigint"),
]


@query(
    """
    SELECT c_custkey AS customer_id, upper(trim(c_name)) AS customer_name,
        coalesce(c_nationkey, -1) AS nation_id, coalesce(c_acctbal, 0.0) AS balance,
        coalesce(lower(nullif(trim(c_mktsegment), '')), 'unknown') AS segment
    FROM customer
    """
)
def p04_customer(spark: SparkSession, folder: str) -> DataFrame:
    return standardise(read_table(spark, folder, "customer"), CUSTOMER_FIELDS)


@query(
    """
    SELECT p_partkey AS part_id,
        array_to_string(list_transform(string_split(trim(p_name), ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') AS part_name,
        coalesce(TRY_CAST(string_split(p_brand, '#')[2] AS INTEGER), -1) AS brand_number,
        coalesce(TRY_CAST(p_type AS INTEGER), 0) AS size_class,
        CAST(p_size AS BIGINT) AS size
    FROM part
    """
)
def p04_part(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").withColumn(
        "brand_number", F.concat(F.lit("  "), F.split("p_brand", "#")[1], F.lit(" "))
    )
    return standardise(part, PART_FIELDS)


# P5


@query(
    """
    SELECT event_id, ts, user_id, event_type, value,
        CAST(json_extract(props, '$.k') AS INTEGER) AS prop_k
    FROM events
    """
)
def p05_flatten(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL("k int")
    return flatten_json(read_table(spark, folder, "events"), "props", schema, "prop_")


@query(
    """
    SELECT * EXCLUDE (props), CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
        CASE WHEN event_id % 9 = 0 THEN 'not json ' || event_id END AS broken
    FROM events
    """
)
def p05_flatten_broken(spark: SparkSession, folder: str) -> DataFrame:
    """Every 9th event's attributes are damaged, and kept as they are."""
    damaged = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("not json "), "event_id")).otherwise(F.col("props"))
    events = read_table(spark, folder, "events").withColumn("props", damaged)
    return flatten_json(events, "props", T.StructType.fromDDL("k int"), bad="broken")


@query(
    """
    SELECT event_id, value AS _json, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
        CASE WHEN event_id % 5 = 0 THEN props || ' ' || event_type END AS broken
    FROM events WHERE event_id % 5 <> 0
    UNION ALL
    SELECT event_id, value, NULL, props || ' ' || event_type FROM events WHERE event_id % 5 = 0
    """
)
def p05_flatten_torn(spark: SparkSession, folder: str) -> DataFrame:
    """Every 5th event's attributes go on behind the object; a column has a name that parsing once used."""
    torn = F.when(F.col("event_id") % 5 == 0, F.concat_ws(" ", "props", "event_type")).otherwise(F.col("props"))
    events = read_table(spark, folder, "events").select("event_id", F.col("value").alias("_json"), torn.alias("props"))
    return flatten_json(events, "props", T.StructType.fromDDL("k int"), bad="broken")


# P22


def _profile_sql() -> str:
    lines = []
    for table, contract in CONTRACTS.items():
        for field in contract.fields:
            name = field.name
            bounds = ("''", "''")
            if not isinstance(field.dataType, T.ArrayType):
                bounds = (f"CAST(min({name}) AS VARCHAR)", f"CAST(max({name}) AS VARCHAR)")
            lines.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS n_rows, "
                f"count(*) - count({name}) AS n_nulls, {bounds[0]} AS least, "
                f"{bounds[1]} AS greatest, count(DISTINCT {name}) AS n_distinct FROM {table}"
            )
    return "\nUNION ALL\n".join(lines)


@query(_profile_sql())
def p22_profile(spark: SparkSession, folder: str) -> DataFrame:
    profiles = [
        profile(read_table(spark, folder, name)).withColumn("table_name", F.lit(name))
        for name in CONTRACTS
    ]
    return reduce(DataFrame.unionByName, profiles)


@query(
    """
    SELECT 'nested' AS column_name, count(*) AS n_rows, count_if(event_id % 10 = 0)::BIGINT AS n_nulls,
        count(DISTINCT CASE WHEN event_id % 10 <> 0 THEN event_type || '/' || user_id END) AS n_distinct FROM events
    UNION ALL SELECT 'zeros', count(*), 0, 1 FROM events
    UNION ALL SELECT 'placed', count(*), 0, count(DISTINCT event_id % 4) FROM events
    """
)
def p22_profile_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Equal maps built in two orders, the two zeros, and arrays that differ only in where nulls stand."""
    nested = spark.sql(
        """
        SELECT CASE WHEN event_id % 10 <> 0 THEN named_struct('of', array(CASE WHEN event_id % 2 = 0
                THEN map('type', event_type, 'user', string(user_id)) ELSE map('user', string(user_id), 'type', event_type) END))
            END AS nested,
            array(named_struct('zero', CASE WHEN event_id % 2 = 0 THEN 0.0D ELSE -0.0D END)) AS zeros,
            CASE event_id % 4 WHEN 0 THEN array(1, NULL) WHEN 1 THEN array(NULL, 1) WHEN 2 THEN array(1) ELSE array() END AS placed
        FROM {events}
        """,
        events=read_table(spark, folder, "events"),
    )
    return profile(nested).select("column_name", "n_rows", "n_nulls", "n_distinct")


@query(f"SELECT table_name, column_name, n_rows, n_nulls, least, greatest, true AS is_close FROM ({_profile_sql()})")
def p22_estimated_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The estimates, and whether each is within a tenth of the exact count."""
    def compared(name: str) -> DataFrame:
        table = read_table(spark, folder, name)
        exact = profile(table).select("column_name", F.col("n_distinct").alias("exact"))
        far = F.abs(F.col("n_distinct") - F.col("exact")) > F.greatest(F.lit(2), F.col("exact") / 10)
        told = estimated_profile(table).join(F.broadcast(exact), "column_name")
        return told.select(
            F.lit(name).alias("table_name"), "column_name", "n_rows", "n_nulls", "least", "greatest", (~far).alias("is_close")
        )

    return reduce(DataFrame.unionByName, [compared(name) for name in CONTRACTS])
