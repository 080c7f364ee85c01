"""P8 to P12, P19 (batch) and P20 on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.functions.columns import money
from packhorse.functions.skew import ROWS_PER_TASK
from packhorse.operators.keys import enrich, guarded_enrich
from packhorse.operators.marts import (
    finest,
    pivot,
    revenue_mart,
    subtotals,
    unpivot,
)
from packhorse.operators.ordered import running, top_k, top_ranks
from packhorse.operators.sessions import sessionise
from packhorse.plans.registry import SMALL_CUT, query
from packhorse.sources.contracts import read_table
from packhorse.streaming.events import tumbling_counts

# The event types.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    """
    SELECT l.*, o_orderdate AS order_date, o_orderstatus AS order_status,
        c_name AS customer, c_mktsegment AS segment, n_name AS nation
    FROM lineitem l
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    """
)
def p08_enrich(spark: SparkSession, folder: str) -> DataFrame:
    customer = enrich(
        read_table(spark, folder, "customer"),
        read_table(spark, folder, "nation"),
        {"c_nationkey": "n_nationkey"},
        {"n_name": "nation"},
    )
    orders = enrich(
        read_table(spark, folder, "orders"),
        customer,
        {"o_custkey": "c_custkey"},
        {"c_name": "customer", "c_mktsegment": "segment", "nation": "nation"},
    )
    return enrich(
        read_table(spark, folder, "lineitem"),
        orders,
        {"l_orderkey": "o_orderkey"},
        {
            "o_orderdate": "order_date", "o_orderstatus": "order_status",
            "customer": "customer", "segment": "segment", "nation": "nation",
        },
    )


# Planted repeats: every third nation stands twice in the dimension, once with another name.
_ORDERS_OF_NATIONS = """
    SELECT o_orderkey, o_totalprice, c_nationkey FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""


@query(
    f"""
    SELECT f.*, CASE WHEN c_nationkey % 3 <> 0 THEN n_name END AS nation, c_nationkey % 3 = 0 AS is_ambiguous
    FROM ({_ORDERS_OF_NATIONS.format(orders="orders", customer="customer")}) f JOIN nation ON c_nationkey = n_nationkey
    """
)
def p08_guarded_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of nations that are there twice come apart, and none is doubled."""
    facts = spark.sql(
        _ORDERS_OF_NATIONS, orders=read_table(spark, folder, "orders"), customer=read_table(spark, folder, "customer")
    )
    nation = read_table(spark, folder, "nation")
    again = nation.filter("n_nationkey % 3 = 0").withColumn("n_name", F.lit("another name"))
    found = guarded_enrich(facts, nation.unionByName(again), {"c_nationkey": "n_nationkey"}, {"n_name": "nation"})
    return found.rows.withColumn("is_ambiguous", F.lit(False)).unionByName(
        found.ambiguous.withColumns({"nation": F.lit(None).cast("string"), "is_ambiguous": F.lit(True)})
    )


@query(
    """
    SELECT n_name AS nation, strftime(o_orderdate, '%Y-%m') AS order_month,
        CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
        count(*) AS n_lines
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
    """
)
def p09_revenue_mart(spark: SparkSession, folder: str) -> DataFrame:
    tables = ("lineitem", "orders", "customer", "nation")
    return revenue_mart(*[read_table(spark, folder, name) for name in tables])


_SUBTOTAL_SQL = """
    SELECT coalesce({a}, 'all') AS {a}, coalesce({b}, 'all') AS {b},
        CAST(grouping({a}, {b}) AS BIGINT) AS level, count(*) AS n_customers,
        CAST(sum(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) AS balance,
        min(c_acctbal) AS least, max(c_acctbal) AS greatest
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY {mode}({a}, {b})
"""


def _balances(spark: SparkSession, folder: str, dimensions: list[str], mode: str) -> DataFrame:
    measures = {
        "n_customers": ("count", F.lit(1)),
        "balance": ("sum", money("c_acctbal")),
        "least": ("min", F.col("c_acctbal")),
        "greatest": ("max", F.col("c_acctbal")),
    }
    customer = read_table(spark, folder, "customer")
    fine = finest(customer, ["c_nationkey", "c_mktsegment"], measures)
    nation = enrich(
        read_table(spark, folder, "nation"),
        read_table(spark, folder, "region"),
        {"n_regionkey": "r_regionkey"},
        {"r_name": "r_name"},
    )
    named = enrich(
        fine, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "r_name": "r_name"}
    )
    kinds = {name: kind for name, (kind, _) in measures.items()}
    return (
        subtotals(named, dimensions, kinds, mode)
        .withColumn("balance", F.col("balance").cast("double"))
        .fillna("all", subset=dimensions)
    )


@query(_SUBTOTAL_SQL.format(a="r_name", b="n_name", mode="ROLLUP"))
def p10_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _balances(spark, folder, ["r_name", "n_name"], "rollup")


@query(_SUBTOTAL_SQL.format(a="r_name", b="c_mktsegment", mode="CUBE"))
def p10_cube(spark: SparkSession, folder: str) -> DataFrame:
    return _balances(spark, folder, ["r_name", "c_mktsegment"], "cube")


_RUNNING_SQL = """
    SELECT o_orderkey, {key} AS buyer, o_totalprice,
        row_number() OVER w AS position,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) OVER
            (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey
             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
        CAST(lag(CAST(o_totalprice AS DECIMAL(18,4))) OVER w AS DOUBLE) AS previous_value
    FROM orders
    WINDOW w AS (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey)
"""

# One buyer in place of all those with orders of one status: about a third.
_SKEWED = "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END"


def _running(orders: DataFrame, rows_per_task: int) -> DataFrame:
    columns = orders.select("o_orderkey", "o_orderdate", "buyer", "o_totalprice")
    value = money("o_totalprice")
    result = running(columns, ["buyer"], ["o_orderdate", "o_orderkey"], value, rows_per_task)
    return result.drop("o_orderdate").withColumns(
        {name: F.col(name).cast("double") for name in ("running_total", "previous_value")}
    )


@query(_RUNNING_SQL.format(key="o_custkey"))
def p11_running(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn("buyer", F.col("o_custkey"))
    return _running(orders, ROWS_PER_TASK)


@query(_RUNNING_SQL.format(key=_SKEWED))
def p11_running_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """As `p11_running`, with one large key and chunks small enough to cut it."""
    orders = read_table(spark, folder, "orders").withColumn("buyer", F.expr(_SKEWED))
    return _running(orders, SMALL_CUT)


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
        FROM orders) WHERE rank <= 3
    """
)
def p11_top_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    return best.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    """
    SELECT kind, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY kind ORDER BY o_totalprice DESC, o_orderkey) AS rank
        FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE o_orderpriority END AS kind FROM orders))
    WHERE rank <= 5000
    """
)
def p11_top_5000_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """More rows per key than Spark limits before the shuffle, half of all rows in one key, and a map column."""
    orders = read_table(spark, folder, "orders").select(
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE o_orderpriority END").alias("kind"),
        "o_orderkey", "o_totalprice", F.create_map("o_orderstatus", "o_custkey").alias("more"),
    )
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return top_k(orders, ["kind"], order, 5000, rows_per_task=SMALL_CUT).drop("more")


@query(
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, rank FROM (
        SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank
        FROM lineitem) WHERE rank <= 20
    """
)
def p11_top_ranks(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    ranked = top_ranks(lines, ["l_suppkey"], "l_quantity", 20)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


_PIVOT_SQL = "SELECT user_id, {} FROM events GROUP BY user_id".format(
    ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in EVENT_TYPES)
)


@query(
    """
    SELECT user_id, count(*) FILTER (event_type = 'click') AS click,
        count(*) FILTER (event_type = 'view') AS view,
        count(*) FILTER (event_type NOT IN ('click', 'view')) AS others
    FROM events GROUP BY user_id
    """
)
def p12_pivot_others(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return pivot(events, ["user_id"], "event_type", ["click", "view"], F.count(F.lit(1)), 0, "others")


@query(_PIVOT_SQL)
def p12_pivot(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return pivot(events, ["user_id"], "event_type", EVENT_TYPES, F.count(F.lit(1)), 0)


@query(
    f"""
    SELECT user_id, event_type, n_events FROM ({_PIVOT_SQL})
    UNPIVOT (n_events FOR event_type IN ({", ".join(EVENT_TYPES)}))
    """
)
def p12_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    wide = p12_pivot(spark, folder)
    return unpivot(wide, ["user_id"], EVENT_TYPES, "event_type", "n_events")


@query(
    """
    SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
        time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
        event_type, count(*) AS n_events,
        CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value
    FROM events GROUP BY ALL
    """
)
def p19_windows_batch(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    counts = tumbling_counts(events, "ts", "10 minutes", ["event_type"], money("value"))
    return counts.withColumn("total_value", F.col("total_value").cast("double"))


_SESSIONS_SQL = """
    WITH seen AS (SELECT * REPLACE ({user} AS user_id) FROM events),
    marked AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
        FROM seen WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS session FROM marked)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
        CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value
    FROM numbered GROUP BY user_id, session
"""
_BUSY_USER = "CASE WHEN value < 30 THEN 0 ELSE user_id END"


def _sessions(events: DataFrame, rows_per_task: int | None) -> DataFrame:
    sessions = sessionise(events, ["user_id"], "ts", 30 * 60, money("value"), rows_per_task)
    return sessions.withColumn("total_value", F.col("total_value").cast("double"))


@query(_SESSIONS_SQL.format(user="user_id"))
def p20_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions(read_table(spark, folder, "events"), None)


@query(_SESSIONS_SQL.format(user=_BUSY_USER))
def p20_sessions_one_large_key(spark: SparkSession, folder: str) -> DataFrame:
    """As `p20_sessions`, with one busy user and chunks small enough to cut it."""
    events = read_table(spark, folder, "events").withColumn("user_id", F.expr(_BUSY_USER))
    return _sessions(events, SMALL_CUT)
