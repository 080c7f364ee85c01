"""P16 to P18 on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.plans.registry import query
from packhorse.session import scratch_path
from packhorse.sources.contracts import read_table
from packhorse.sources.incremental import extract_after, highest_mark, load_mark, save_mark
from packhorse.sources.loads import load_partitions, upsert, upsert_partitions
from packhorse.sources.switched import load_switched, read_switched, upsert_switched

# An earlier run has taken the events up to the 15th

_TAKEN = "2024-01-16"


@query(
    f"""
    SELECT e.event_id, e.ts, e.user_id, e.value, m.at AS mark_at, m.id AS mark_id
    FROM events e,
        (SELECT max(ts) AS at, max_by(event_id, ts) AS id FROM events) m
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_TAKEN}')
    """
)
def p16_incremental(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    marks = scratch_path(spark, "marks")
    earlier = events.filter(F.col("ts") < F.lit(_TAKEN).cast("timestamp_ntz"))
    save_mark(spark, marks, highest_mark(earlier, "ts", "event_id"))

    rows, _, mark, _ = extract_after(events, "ts", "event_id", load_mark(spark, marks))
    loaded = scratch_path(spark, "loaded")
    rows.write.parquet(loaded)
    save_mark(spark, marks, mark)
    return spark.read.schema(rows.schema).parquet(loaded).select(
        "event_id", "ts", "user_id", "value",
        mark.time().alias("mark_at"),
        mark.id().alias("mark_id"),
    )


# Fixed damage: every 7th event has no time, every 11th arrives two runs late.
_ARRIVALS = """
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, user_id, value FROM {events}
"""


@query(
    f"""
    SELECT event_id, ts, user_id, value, CASE WHEN ts IS NULL THEN 'undated'
        WHEN event_id % 11 = 0 AND ts <= TIMESTAMP '{_TAKEN}' THEN 'second' WHEN ts < TIMESTAMP '{_TAKEN}' THEN 'first'
        ELSE 'second' END AS run
    FROM ({_ARRIVALS.format(events="events")})
    WHERE ts IS NULL OR event_id % 11 <> 0 OR ts > (
        SELECT max(ts) - INTERVAL 5 DAY FROM events
        WHERE ts < TIMESTAMP '{_TAKEN}' AND event_id % 7 <> 0 AND event_id % 11 <> 0)
    """
)
def p16_incremental_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs: late rows come with the second if they are at most five days late, undated rows apart."""
    events = spark.sql(_ARRIVALS, events=read_table(spark, folder, "events"))
    marks, table = scratch_path(spark, "marks"), scratch_path(spark, "loaded")
    there = events.filter((F.col("ts") < F.lit(_TAKEN).cast("timestamp_ntz")) & (F.col("event_id") % 11 != 0))
    for run, source in (("first", there), ("second", events)):
        mark = load_mark(spark, marks)
        loaded = events.limit(0) if mark is None else spark.read.schema(events.schema).parquet(table)
        found = extract_after(source, "ts", "event_id", mark, "5 DAYS", loaded)
        rows = found.rows.withColumn("run", F.lit(run))
        rows = rows.unionByName(found.undated.withColumn("run", F.lit("undated")))
        rows.write.mode("append").parquet(table)
        save_mark(spark, marks, found.mark)
    return spark.read.parquet(table)


# Fixed damage: every 13th event has no id, and ids are text, whose order is not that of the numbers.
_TEXT_IDS = """
    SELECT CASE WHEN event_id % 13 <> 0 THEN 'e' || event_id END AS id, date_trunc('hour', ts)::TIMESTAMP{kind} AS hour,
        user_id, value FROM {events}
"""


@query(
    f"""
    SELECT *, CASE WHEN hour <= TIMESTAMP '{_TAKEN}' THEN 'first' ELSE 'second' END
        || CASE WHEN id IS NULL THEN ', unnamed' ELSE '' END AS run
    FROM ({_TEXT_IDS.format(events="events", kind="")})
    """
)
def p16_incremental_null_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, with many events at the time of the mark; those without an id come apart, once each."""
    events = spark.sql(_TEXT_IDS.format(events="{events}", kind="_NTZ"), events=read_table(spark, folder, "events"))
    marks, table = scratch_path(spark, "marks"), scratch_path(spark, "loaded")
    there = events.filter(F.col("hour") <= F.lit(_TAKEN).cast("timestamp_ntz"))
    for run, source in (("first", there), ("second", events)):
        found = extract_after(source, "hour", "id", load_mark(spark, marks))
        rows = found.rows.withColumn("run", F.lit(run))
        rows = rows.unionByName(found.unnamed.withColumn("run", F.lit(f"{run}, unnamed")))
        rows.write.mode("append").parquet(table)
        save_mark(spark, marks, found.mark)
    return spark.read.parquet(table)


# Finished orders are repriced, urgent ones twice; some orders are new

_UPSERT_SQL = """
    SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_totalprice
        WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 2
        ELSE o_totalprice + 1 END AS o_totalprice) FROM orders
    UNION ALL
    SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders
    WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
"""


def _changes(orders: DataFrame) -> DataFrame:
    finished = F.col("o_orderstatus") == "F"
    price = F.col("o_totalprice")
    repriced = orders.filter(finished).withColumns(
        {"o_totalprice": price + 1, "version": F.lit(1)}
    )
    again = orders.filter(finished & (F.col("o_orderpriority") == "1-URGENT")).withColumns(
        {"o_totalprice": price + 2, "version": F.lit(2)}
    )
    added = orders.filter(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    ).withColumns({"o_orderkey": -1 - F.col("o_orderkey"), "version": F.lit(1)})
    return repriced.unionByName(again).unionByName(added)


@query(_UPSERT_SQL)
def p17_upsert(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return upsert(orders, _changes(orders), ["o_orderkey"], [F.desc("version")])


# P18



def _with_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_year", F.year("o_orderdate"))


@query(
    """
    SELECT *, CAST(extract(year FROM o_orderdate) AS INTEGER) AS o_year FROM orders
    WHERE extract(year FROM o_orderdate) <> 1997 OR o_orderstatus = 'F'
    """
)
def p18_partitioned_load(spark: SparkSession, folder: str) -> DataFrame:
    """Load all years, then 1997 anew with finished orders only."""
    orders = _with_year(read_table(spark, folder, "orders"))
    path = scratch_path(spark, "orders-by-year")
    load_partitions(orders, path, ["o_year"])
    anew = orders.filter((F.col("o_year") == 1997) & (F.col("o_orderstatus") == "F"))
    load_partitions(anew, path, ["o_year"])
    return spark.read.parquet(path)


@query(
    f"""
    SELECT *, CAST(extract(year FROM o_orderdate) AS INTEGER) AS o_year FROM (
        SELECT * FROM orders WHERE extract(year FROM o_orderdate) <> 1998
        UNION ALL
        SELECT * FROM ({_UPSERT_SQL}) WHERE extract(year FROM o_orderdate) = 1998)
    """
)
def p18_partitioned_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Load all years, then upsert the changes that fall into 1998."""
    orders = _with_year(read_table(spark, folder, "orders"))
    path = scratch_path(spark, "orders-by-year")
    load_partitions(orders, path, ["o_year"])
    changes = _changes(orders).filter(F.col("o_year") == 1998)
    upsert_partitions(spark, path, changes, ["o_orderkey"], ["o_year"], [F.desc("version")])
    return spark.read.parquet(path)


@query(
    f"""
    SELECT *, CAST(extract(year FROM o_orderdate) AS INTEGER) AS o_year FROM (
        SELECT * REPLACE (CASE WHEN extract(year FROM o_orderdate) = 1995 OR o_orderpriority = '1-URGENT'
            THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END AS o_orderdate)
        FROM orders WHERE extract(year FROM o_orderdate) < 1999)
    """
)
def p18_upsert_moved_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders move to the next year, and all of 1995 do, so that its partition is gone."""
    orders = _with_year(read_table(spark, folder, "orders")).filter("o_year < 1999")
    path = scratch_path(spark, "orders-by-year")
    load_partitions(orders, path, ["o_year"])
    later = orders.filter((F.col("o_year") == 1995) | (F.col("o_orderpriority") == "1-URGENT"))
    later = _with_year(later.withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 1 YEAR")))
    changes = later.withColumn("version", F.lit(1))
    upsert_partitions(spark, path, changes, ["o_orderkey"], ["o_year"], [F.desc("version")])
    return spark.read.parquet(path)


# Partitions whose names Spark, or a URI, writes in another way.
_BINS = {
    "1-URGENT": "a b", "2-HIGH": "a:b", "3-MEDIUM": "a%20b", "4-NOT SPECIFIED": "é/ü=1 #?", "5-LOW": None,
}
_BIN_SQL = "CASE o_orderpriority " + " ".join(
    f"WHEN '{priority}' THEN {'NULL' if name is None else repr(name)}" for priority, name in _BINS.items()
) + " END"
# Finished orders move to another bin, and so does all of one.
_MOVES_SQL = "o_orderstatus = 'F' OR o_orderpriority = '2-HIGH'"


def _binned(orders: DataFrame) -> DataFrame:
    return orders.withColumn("bin", F.expr(_BIN_SQL))


def _moved(orders: DataFrame) -> DataFrame:
    moved = orders.filter(F.expr(_MOVES_SQL))
    return moved.withColumns({"bin": F.lit("o%2Fther"), "o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(1)})


_MOVED_SQL = f"""
    SELECT * REPLACE (CASE WHEN {_MOVES_SQL} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice),
        CASE WHEN {_MOVES_SQL} THEN 'o%2Fther' ELSE {_BIN_SQL} END AS bin
    FROM orders
"""


@query(_MOVED_SQL)
def p18_upsert_moved_text_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orders move out of partitions with spaces, colons and percent signs in their names."""
    orders = _binned(read_table(spark, folder, "orders"))
    path = scratch_path(spark, "orders-by-bin")
    load_partitions(orders, path, ["bin"])
    upsert_partitions(spark, path, _moved(orders), ["o_orderkey"], ["bin"], [F.desc("version")])
    return spark.read.schema(orders.schema).parquet(path)


@query(_MOVED_SQL)
def p18_switched_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a pointer, in two upserts."""
    orders = _binned(read_table(spark, folder, "orders"))
    path = scratch_path(spark, "orders-switched")
    load_switched(spark, path, orders, ["bin"])
    moved = _moved(orders)
    for part in (moved.filter("o_orderkey % 2 = 0"), moved.filter("o_orderkey % 2 <> 0")):
        upsert_switched(spark, path, part, ["o_orderkey"], [F.desc("version")])
    return read_switched(spark, path)


@query(
    f"""
    SELECT *, {_BIN_SQL} AS bin FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
    """
)
def p18_switched_load(spark: SparkSession, folder: str) -> DataFrame:
    """One partition is loaded anew with fewer rows, another is emptied."""
    orders = _binned(read_table(spark, folder, "orders"))
    path = scratch_path(spark, "orders-switched")
    load_switched(spark, path, orders, ["bin"])
    anew = orders.filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"))
    load_switched(spark, path, anew, ["bin"], emptied=orders.filter("o_orderpriority = '1-URGENT'").select("bin"))
    return read_switched(spark, path)
