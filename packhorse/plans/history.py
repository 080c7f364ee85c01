"""P6, P7, P13, P14 and P15 on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.functions.skew import ROWS_PER_TASK
from packhorse.operators.history import as_of, type2_history
from packhorse.operators.keys import dedupe_latest, duplicated_keys, matched, orphans, snapshot_changes, snapshot_diff
from packhorse.plans.registry import SMALL_CUT, query
from packhorse.sources.contracts import read_table

# P6


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1
    """
)
def p06_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return dedupe_latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def p06_duplicated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicated_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# P7


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def p07_orphans(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = (read_table(spark, folder, name) for name in ("orders", "lineitem"))
    return orphans(orders, lineitem, {"o_orderkey": "l_orderkey"})


@query("SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def p07_matched(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = (read_table(spark, folder, name) for name in ("orders", "lineitem"))
    return matched(orders, lineitem, {"o_orderkey": "l_orderkey"})


# One order in place of all those with returned lines: a third of the lines.
_SKEWED_LINES = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_orderkey END"


@query(
    f"""
    SELECT {_SKEWED_LINES} AS order_key, l_partkey, l_suppkey, l_linenumber, l_extendedprice
    FROM lineitem
    WHERE order_key NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """
)
def p07_orphans_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """Lines without a finished order, one order being large and kept out of the shuffle."""
    lines = read_table(spark, folder, "lineitem").select(
        F.expr(_SKEWED_LINES).alias("order_key"),
        "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    )
    finished = read_table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    return orphans(lines, finished, {"order_key": "o_orderkey"}, SMALL_CUT)


# P13

_NEW_ORDERS = """
    SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
             THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'
             THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM {orders} WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
    UNION ALL
    SELECT -1 - o_orderkey AS o_orderkey, o_totalprice, o_orderpriority
    FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
"""


_DIFF_SQL = f"""
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
        CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete'
             WHEN o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice
              AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority THEN 'same'
             ELSE 'update' END AS change,
        CASE WHEN o.o_orderkey IS NULL OR n.o_orderkey IS NULL THEN '' ELSE concat_ws(',',
            CASE WHEN o.o_totalprice IS DISTINCT FROM n.o_totalprice THEN 'o_totalprice' END,
            CASE WHEN o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
                 THEN 'o_orderpriority' END) END AS changed,
        o.o_totalprice AS old_price, n.o_totalprice AS new_price,
        o.o_orderpriority AS old_priority, n.o_orderpriority AS new_priority
    FROM orders o FULL JOIN ({_NEW_ORDERS.format(orders="orders")}) n USING (o_orderkey)
"""


@query(_DIFF_SQL)
def p13_diff(spark: SparkSession, folder: str) -> DataFrame:
    old = read_table(spark, folder, "orders")
    new = spark.sql(_NEW_ORDERS, orders=old)
    return _told(snapshot_diff(old, new, ["o_orderkey"], ["o_totalprice", "o_orderpriority"]))


def _told(diff: DataFrame) -> DataFrame:
    return diff.select(
        "o_orderkey", "change", F.array_join("changed", ",").alias("changed"),
        F.col("old.o_totalprice").alias("old_price"),
        F.col("new.o_totalprice").alias("new_price"),
        F.col("old.o_orderpriority").alias("old_priority"),
        F.col("new.o_orderpriority").alias("new_priority"),
    )


@query(f"SELECT * FROM ({_DIFF_SQL}) WHERE change <> 'same'")
def p13_changes(spark: SparkSession, folder: str) -> DataFrame:
    old = read_table(spark, folder, "orders")
    new = spark.sql(_NEW_ORDERS, orders=old)
    return _told(snapshot_changes(old, new, ["o_orderkey"], ["o_totalprice", "o_orderpriority"]))


@query(
    """
    SELECT user_id, CASE WHEN bool_or(event_type = 'error' AND value > 50) THEN 'update' ELSE 'same' END AS change
    FROM events GROUP BY user_id
    """
)
def p13_diff_of_maps(spark: SparkSession, folder: str) -> DataFrame:
    """Maps of each user's events, built in two orders; large errors are changed."""
    events = read_table(spark, folder, "events").withColumn("name", F.concat_ws("-", "event_type", "event_id"))

    def maps(value: Column, order: Column) -> DataFrame:
        entry = F.struct(order.alias("o"), F.struct("name", value.alias("value")).alias("e"))
        entries = F.transform(F.sort_array(F.collect_list(entry)), lambda item: item.e)
        return events.groupBy("user_id").agg(F.map_from_entries(entries).alias("of"))

    changed = F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.col("value") + 1).otherwise(F.col("value"))
    old, new = maps(F.col("value"), F.col("event_id")), maps(changed, -F.col("event_id"))
    diff = snapshot_diff(old, new, ["user_id"], ["of"])
    changes = snapshot_changes(old, new, ["user_id"], ["of"]).filter("change = 'update' AND changed[0] = 'of'")
    # Both operators have to agree.
    return diff.filter("change = 'same'").select("user_id", "change").unionByName(changes.select("user_id", "change"))



# P14

_SKEWED_ORDERS = "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END"

_HISTORY_SQL = """
    WITH marked AS (
        SELECT o_orderkey, {key} AS buyer, o_orderpriority, o_orderdate,
            lag(o_orderpriority) OVER (
                PARTITION BY {key} ORDER BY o_orderdate, o_orderkey) AS before
        FROM orders)
    SELECT o_orderkey, buyer, o_orderpriority, o_orderdate AS valid_from,
        lead(o_orderdate) OVER (PARTITION BY buyer ORDER BY o_orderdate, o_orderkey) AS valid_to,
        lead(o_orderdate) OVER (PARTITION BY buyer ORDER BY o_orderdate, o_orderkey) IS NULL
            AS is_current
    FROM marked {where}
"""
_CHANGED = "WHERE before IS DISTINCT FROM o_orderpriority"


def _history(orders: DataFrame, track: list[str] | None, rows_per_task: int) -> DataFrame:
    columns = orders.select("o_orderkey", "buyer", "o_orderpriority", "o_orderdate")
    return type2_history(
        columns, ["buyer"], "o_orderdate", "o_orderkey", track, rows_per_task
    ).drop("o_orderdate")


@query(_HISTORY_SQL.format(key="o_custkey", where=""))
def p14_history(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn("buyer", F.col("o_custkey"))
    return _history(orders, None, ROWS_PER_TASK)


@query(_HISTORY_SQL.format(key="o_custkey", where=_CHANGED))
def p14_history_of_changes(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn("buyer", F.col("o_custkey"))
    return _history(orders, ["o_orderpriority"], ROWS_PER_TASK)


@query(_HISTORY_SQL.format(key=_SKEWED_ORDERS, where=_CHANGED))
def p14_history_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """As `p14_history_of_changes`, with one large key and chunks small enough to cut it."""
    orders = read_table(spark, folder, "orders").withColumn("buyer", F.expr(_SKEWED_ORDERS))
    return _history(orders, ["o_orderpriority"], SMALL_CUT)


# P15

_AS_OF_SQL = """
    SELECT p.event_id, p.user_id, p.ts, p.value,
        coalesce(v.event_id, -1) AS view_id, v.ts AS view_ts, v.value AS view_value
    FROM (SELECT * REPLACE ({user} AS user_id) FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * REPLACE ({user} AS user_id) FROM events WHERE event_type = 'view') v
    ON p.user_id = v.user_id AND p.ts > v.ts
"""
_SKEWED_EVENTS = "CASE WHEN value < 30 THEN 0 ELSE user_id END"


def _as_of(events: DataFrame, rows_per_task: int) -> DataFrame:
    events = events.select("event_id", "user_id", "ts", "event_type", "value")
    purchases = events.filter(F.col("event_type") == "purchase").drop("event_type")
    views = events.filter(F.col("event_type") == "view").drop("event_type")
    order = ["ts", "event_id"]
    return as_of(purchases, views, ["user_id"], order, order, "view", rows_per_task).select(
        "event_id", "user_id", "ts", "value",
        F.coalesce("view.event_id", F.lit(-1)).alias("view_id"),
        F.col("view.ts").alias("view_ts"),
        F.col("view.value").alias("view_value"),
    )


@query(_AS_OF_SQL.format(user="user_id"))
def p15_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _as_of(read_table(spark, folder, "events"), ROWS_PER_TASK)


@query(_AS_OF_SQL.format(user=_SKEWED_EVENTS))
def p15_as_of_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """As `p15_as_of`, with one large key and chunks small enough to cut it."""
    events = read_table(spark, folder, "events").withColumn("user_id", F.expr(_SKEWED_EVENTS))
    return _as_of(events, SMALL_CUT)


# Fixed damage: every 7th user and every 5th time is missing.
_NULLED = """
    SELECT event_id, event_type, value, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
        CASE WHEN event_id % 5 <> 0 THEN ts END AS ts FROM {events}
"""


@query(
    f"""
    WITH e AS ({_NULLED.format(events="events")})
    SELECT p.event_id, p.user_id, p.ts, p.value, coalesce(v.event_id, -1) AS view_id, v.ts AS view_ts, v.value AS view_value
    FROM (SELECT * FROM e WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view' AND ts IS NOT NULL AND user_id IS NOT NULL) v
    ON p.user_id = v.user_id AND p.ts > v.ts
    """
)
def p15_as_of_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.sql(_NULLED, events=read_table(spark, folder, "events"))
    return _as_of(events, ROWS_PER_TASK)
