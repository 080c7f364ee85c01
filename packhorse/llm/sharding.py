"""Operator 9: shards by a permutation-filled lookup table.

Shards take turns. Each claims, by an order of preference of its own, the next
free slot of a table whose size is prime, so every shard gets as many slots as
the others, give or take one, and a shard that joins or leaves moves few slots.
A key is placed by its hash's slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.functions.columns import unused
from packhorse.llm.common import table
from packhorse.session import scratch_path

SLOTS_PER_SHARD = 100
MOST_SLOTS = 5_000_000
# Hexadecimal digits of md5 that make a number; 15 fit a long.
DIGITS = 15


@dataclass(frozen=True)
class Lookup:
    shards: tuple[str, ...]
    owners: tuple[int, ...]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def prime_from(least: int) -> int:
    """The smallest prime that is not less than `least`."""
    n = max(least, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def fill(shards: Sequence[str], slots: int | None = None) -> Lookup:
    """The lookup table of distinct names; the order in which they are given does not matter.

    `slots` must be prime and no less than the number of shards.
    """
    names = tuple(sorted(set(shards)))
    if not names:
        raise ValueError("no shards")
    size = slots or prime_from(SLOTS_PER_SHARD * len(names))
    if size < len(names) or prime_from(size) != size or size > MOST_SLOTS:
        raise ValueError(f"{size} slots for {len(names)} shards: need a prime, at most {MOST_SLOTS}")
    first = [_number(f"offset:{name}") % size for name in names]
    step = [_number(f"skip:{name}") % (size - 1) + 1 for name in names]
    owners, tried, left = [-1] * size, [0] * len(names), size
    while left:
        for shard in range(len(names)):
            slot = (first[shard] + tried[shard] * step[shard]) % size
            while owners[slot] >= 0:
                tried[shard] += 1
                slot = (first[shard] + tried[shard] * step[shard]) % size
            owners[slot] = shard
            left -= 1
            if not left:
                break
    return Lookup(names, tuple(owners))


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key, from the md5 of its text; a null key is placed like an empty one."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long") % slots


def place(df: DataFrame, lookup: Lookup, key: str = "doc_id", slot: str = "slot", shard: str = "shard") -> DataFrame:
    """`df` with the `slot` of `key` and the name of its `shard`.

    Equal keys are placed together, nulls among them; texts are not looked at.
    Columns that are already named `slot` or `shard` are replaced, all others
    stay, whatever their names; an empty table gives an empty one. The lookup table, of at most `MOST_SLOTS` short
    rows, is broadcast, so no row is moved.
    """
    spark, slots = df.sparkSession, len(lookup.owners)
    number, of_number, name = (unused(one, df.columns) for one in ("number", "of_number", "name"))
    rows = [(at, lookup.shards[owner]) for at, owner in enumerate(lookup.owners)]
    owners = spark.createDataFrame(rows, f"`{of_number}` long, `{name}` string")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (slot, shard)]
    told = df.withColumn(number, slot_of(F.col(f"`{key}`"), slots))
    told = told.join(F.broadcast(owners), F.col(number) == F.col(of_number))
    return told.select(*kept, F.col(number).alias(slot), F.col(name).alias(shard))


def write_shards(df: DataFrame, lookup: Lookup, path: str, key: str = "doc_id") -> None:
    """`df` as Parquet with a folder per shard; large shards are written by several tasks.

    Null and repeated keys, long texts and other columns are as in `place`; a column
    named `shard` or `slot` is left out. An empty table gives a table without rows.
    """
    placed = place(df, lookup, key)
    placed.drop("slot").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


PRODUCTION_SHARDS = tuple(f"shard-{number:03d}" for number in range(32))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written by shard to the scratch folder; the result is read from there."""
    docs, lookup = table(spark, sf_dir, "documents"), fill(PRODUCTION_SHARDS)
    path = scratch_path(spark, "shards")
    write_shards(docs, lookup, path)
    written = spark.read.schema(docs.schema.add("shard", "string")).parquet(path)
    return written.select("doc_id", "n_chars", slot_of(F.col("doc_id"), len(lookup.owners)).alias("slot"), "shard")


def _oracle(shards: int, slots: int) -> str:
    """The turns as a recursive query: each step lets one shard claim a slot."""
    return f"""
        WITH RECURSIVE shard AS (
            SELECT i, 'shard-' || lpad(i::VARCHAR, 3, '0') AS name,
                ('0x' || substr(md5('offset:' || name), 1, {DIGITS}))::BIGINT % {slots} AS first,
                ('0x' || substr(md5('skip:' || name), 1, {DIGITS}))::BIGINT % {slots - 1} + 1 AS step
            FROM range({shards}) t(i)),
        preferences AS (
            SELECT list(order_of ORDER BY i) AS p FROM (
                SELECT i, list_transform(range({slots}), lambda j: (first + j * step) % {slots}) AS order_of FROM shard)),
        turns AS (
            SELECT 0 AS t, -1::BIGINT AS slot, repeat('0', {slots})::BIT AS taken
            UNION ALL
            SELECT t + 1, s, set_bit(taken, s::INTEGER, 1)
            FROM (SELECT t, taken, list_filter(p[t % {shards} + 1], lambda c: get_bit(taken, c::INTEGER) = 0)[1] AS s
                  FROM turns, preferences WHERE t < {slots}))
        SELECT doc_id, n_chars, d.slot, name AS shard
        FROM (SELECT doc_id, n_chars, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT % {slots} AS slot FROM documents) d
            JOIN turns ON turns.slot = d.slot JOIN shard ON shard.i = (turns.t - 1) % {shards}
    """


QUERIES = {"op9_sharding": op9_sharding}
ORACLES = {"op9_sharding": _oracle(len(PRODUCTION_SHARDS), prime_from(SLOTS_PER_SHARD * len(PRODUCTION_SHARDS)))}
