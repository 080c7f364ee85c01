"""Operator 5: exact n-gram Jaccard self-join with set-relation skipping.

Sets are indexed by their rarest shingles (prefix filter). Index lists are read
in blocks: of sets of like size, whose positions decide whether a pair can still
reach the threshold. In each list one set, the leader, is compared with all
others first. What is known of the leader gives the answers of sets that are
highly similar to it: they are in its class, and by the triangle inequality only
sets about as far from the leader can be theirs. Only what that leaves open is
compared pair by pair, and never within a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import unused
from packhorse.functions.digest import digest
from packhorse.llm.classes import smallest_reachable
from packhorse.llm.common import bounded_broadcast, by_small_batches, give_back, stored, table
from packhorse.llm.shingles import bucket_counts, bucket_of, described, scan, set_id, shingle_set
from packhorse.operators.ordered import top_k

# The similarity is 4/5. Entries of a list that is expected to be longer are dealt to blocks of this length.
LIST = 4096
# Tables of short rows with no more than this are broadcast.
FEW = 2_000_000
# Names of sets that a task remembers, to leave out copies before the shuffle that merges the others.
SEEN = 200_000
BLOCKS = 0xFFF
# Blocks of positions that a prefix is cut into; rows of one block are alike, and shuffle small.
PLACES = 8


def _ordered(items: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Items from rare to common, with the powers of two that say how common, and the length of the prefix."""
    level = np.frexp(counts[bucket_of(items)].astype(float))[1]
    order = np.lexsort((items, level))
    n = len(items)
    return items[order], level[order], n - (4 * n + 4) // 5 + 1


def _index(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """Per set the entries of its prefix: list, set, place (size and block of positions), and how common its prefix is.

    Shingles are ordered by how common their bucket is, in powers of two, then
    by hash. A list is a shingle without its low bits, which hold the block.
    """
    usual = int(shared.value.mean()) + 1

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        seen: set[int] = set()
        names = ("list", "set", "place", "hub")
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in names]
            held = 0
            for text in batch["text"]:
                items = shingle_set(text)
                name = set_id(items)
                if not len(items) or name in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(name)
                n = len(items)
                ordered, level, size = _ordered(items, counts)
                prefix = ordered[:size]
                common = counts[bucket_of(prefix)].astype(np.int64)
                blocks = np.minimum(np.maximum(common - 4 * usual, 0) // LIST + 1, BLOCKS)
                block = np.where(blocks > 1, 1 + name % blocks, 0).astype(np.uint64)
                columns[0].append(((prefix & ~np.uint64(BLOCKS)) | block).view(np.int64))
                columns[1].append(np.full(size, name, np.int64))
                columns[2].append(n * PLACES + np.arange(size, dtype=np.int64) * PLACES // size)
                columns[3].append(np.full(size, int(level[:size].sum()), np.int64))
                held += size
                if held >= 200_000:
                    yield pd.DataFrame({name: np.concatenate(part) for name, part in zip(names, columns, strict=True)})
                    columns, held = [[] for _ in names], 0
            if held:
                yield pd.DataFrame({name: np.concatenate(part) for name, part in zip(names, columns, strict=True)})
        seen.clear()
        give_back()

    return texts.mapInPandas(work, "list long, set long, place long, hub long")


def _sets_of(texts: DataFrame, wanted: DataFrame, counts: Broadcast, label: str) -> DataFrame:
    """The wanted sets (set, text_hash), read again from a text that has them: n, head (the prefix) and items."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for name, text in zip(batch["set"], batch["text"], strict=True):
                if name in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(name)
                items, _, size = _ordered(shingle_set(text), counts.value)
                rows.append((name, len(items), items[:size].tobytes(), items.tobytes()))
            yield pd.DataFrame(rows, columns=["set", "n", "head", "items"])
        seen.clear()
        give_back()

    found = texts.select("text_hash", "text").join(wanted, "text_hash").select("set", "text")
    read = found.mapInPandas(work, "set long, n long, head binary, items binary")
    copies = stored(read.withColumn("part", F.spark_partition_id()), label)
    # Tasks that met copies of one text have all read its set: the first counts.
    # So that no set is shuffled for it, the choice is broadcast while it is small.
    chosen = stored(copies.groupBy("set").agg(F.min("part").alias("part")), f"{label}-chosen")
    return copies.join(bounded_broadcast(chosen, FEW), ["set", "part"], "left_semi").drop("part")


@F.pandas_udf(T.LongType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    def size(x: bytes, y: bytes) -> int:
        both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
        both.sort(kind="stable")
        return int((both[1:] == both[:-1]).sum())

    return pd.Series([size(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def _with_shared(pairs: DataFrame, sets: DataFrame, what: str) -> DataFrame:
    """Pairs (a, b) with their sizes n and m, and how many of the items in the column `what` they share."""

    def side(name: str) -> DataFrame:
        # Only sets that the pairs name on this side are shuffled.
        named = bounded_broadcast(pairs.select(F.col(name).alias("set")).distinct(), FEW)
        return sets.join(named, "set", "left_semi")

    left = side("a").select(F.col("set").alias("a"), "n", F.col(what).alias("x"))
    right = side("b").select(F.col("set").alias("b"), F.col("n").alias("m"), F.col(what).alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "n", "m", _shared("x", "y").alias("shared"))


def _verified(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """The pairs (a, b) that their prefixes do not rule out, with their distance and whether they link."""
    open_pairs = _with_shared(pairs, sets, "head").filter(_can_link(F.col("n"), F.col("m"), F.col("shared")))
    told = _with_shared(stored(open_pairs.select("a", "b").distinct(), f"{label}-open"), sets, "items")
    union = F.col("n") + F.col("m") - F.col("shared")
    return stored(
        told.select(
            "a", "b", (1 - F.col("shared") / union).alias("far"), (100 * F.col("shared") >= 80 * union).alias("linked")
        ).distinct(),
        label,
    )


def _least_shared(n: Column, m: Column) -> Column:
    """How many items linked sets of n and m items share at least: 4/9 of both, rounded up.

    Of items in one order, one of the first n - shared + 1 of n items is then shared.
    """
    return F.floor((4 * (n + m) + 8) / 9)


def _first_position(n: Column, part: Column) -> Column:
    """The first position, from 0, of a block of positions of a prefix."""
    size = n - F.floor((4 * n + 4) / 5) + 1
    return F.ceil(part * size / PLACES)


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.25)) + F.lit(1e-9)).cast("int")


def _can_link(n: Column, m: Column, met: Column) -> Column:
    """Whether sets of n and m items whose prefixes share `met` items can be linked.

    What the prefixes do not show lies behind the prefix that ends first, so the
    sets share at most `met` and what is left of one of them; they need 4/9 of both.
    """
    left = F.floor((4 * F.greatest(n, m) + 4) / 5) - 1
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * (met + left) >= 4 * (n + m))


def _open_pairs(entries: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of sets of different classes that may be linked, from all lists.

    Lists of one class only are skipped whole; then blocks of other sizes; then
    positions that come too late for the sizes of a pair, and sets whose
    distances from a common leader are too different.
    """
    far = known.select(F.col("a").alias("set"), F.col("b").alias("lead"), "far")
    told = (
        entries.join(bounded_broadcast(far, FEW), ["set", "lead"], "left")
        .join(bounded_broadcast(classes, FEW), "set", "left")
        .select(
            "set", "n", "pos", "lead", F.coalesce("class", "set").alias("class"),
            F.when(F.col("set") == F.col("lead"), F.lit(0.0)).otherwise(F.col("far")).alias("far"),
            F.col("list").bitwiseAND(F.lit(~BLOCKS)).alias("token"),
        )
    )
    told = stored(told, "list-entries")
    mixed = told.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high")
    live = told.join(mixed.select("token"), "token", "left_semi")
    # Blocks of sizes, each a power of 5/4 wide. A set meets larger ones up to the
    # size from which its position comes too late: 9 * (n - pos) >= 4 * (n + m).
    n, most = F.col("n"), F.floor((9 * (F.col("n") - F.col("pos")) - 4 * F.col("n")) / 4)
    small = live.filter(most >= n).withColumn("band", F.explode(F.sequence(_band(n), _band(most))))
    far_apart = (F.col("s.lead") == F.col("l.lead")) & (F.abs(F.col("s.far") - F.col("l.far")) > 0.2 + 1e-9)
    sizes = (F.col("s.n") < F.col("l.n")) | ((F.col("s.n") == F.col("l.n")) & (F.col("s.set") < F.col("l.set")))
    shared = _least_shared(F.col("s.n"), F.col("l.n"))
    pairs = small.alias("s").join(
        live.withColumn("band", _band(n)).alias("l"),
        (F.col("s.token") == F.col("l.token")) & (F.col("s.band") == F.col("l.band")) & sizes
        & (F.col("s.class") != F.col("l.class")) & (5 * F.col("s.n") >= 4 * F.col("l.n"))
        & (F.col("s.pos") <= F.col("s.n") - shared) & (F.col("l.pos") <= F.col("l.n") - shared)
        & ~F.coalesce(far_apart, F.lit(False)),
    )
    return pairs.select(F.col("s.set").alias("a"), F.col("l.set").alias("b")).distinct()


def jaccard_rows(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of `df`: key, text_hash, n, its class (a set's name, null without words), and component_id.

    Two rows link when their sets of five-word shingles have a Jaccard similarity
    of 0.8 or more; component_id is the smallest key that links reach. Sets are
    compared by 64-bit hashes. Rows without words, null texts among them, link
    with nothing and are their own component, as is a row with a null key
    that links with no other. Repeated keys and rows are all returned. Other columns
    of `df` are left aside, whatever their names; an empty table gives an empty one.
    """
    texts = by_small_batches(df).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    scanned = scan(texts, "scanned")
    rows = described(scanned)
    counts = df.sparkSession.sparkContext.broadcast(bucket_counts(scanned))

    # A list holds about `LIST` entries at most, so a window over it is bounded.
    whole = Window.partitionBy("list")
    parted = _index(texts.select("text"), counts).withColumns(
        {"n": F.floor(F.col("place") / PLACES), "part": F.col("place") % PLACES}
    ).withColumn("pos", _first_position(F.col("n"), F.col("part")))
    dealt = parted.withColumns(
        {
            "low": F.min("set").over(whole), "high": F.max("set").over(whole),
            "early": F.max(F.col("pos") <= F.col("n") - _least_shared(F.col("n"), F.col("n"))).over(whole),
            "top": F.max(F.struct("hub", "set", "n")).over(whole),
        }
        # A pair meets where the smaller set has one of its earliest items. A list
        # that is one of several blocks may have its other members in them.
    ).filter(((F.col("low") != F.col("high")) & F.col("early")) | (F.col("list").bitwiseAND(F.lit(BLOCKS)) != 0))
    entries = stored(
        dealt.select("list", "set", "n", "pos", F.col("top.set").alias("lead"), F.col("top.n").alias("lead_n")).distinct(),
        "entries",
    )
    source = rows.groupBy("set").agg(F.min("text_hash").alias("text_hash"))

    def compared(pairs: DataFrame, label: str) -> DataFrame:
        pairs = stored(pairs, label)
        members = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
        wanted = bounded_broadcast(stored(members.join(source, "set"), "wanted"), FEW)
        return _verified(pairs, _sets_of(texts, wanted, counts, "sets"), f"{label}-verified")

    # Where a set meets its leader often enough; whatever is not compared here stays open.
    first = entries.filter("set != lead").groupBy(
        F.col("set").alias("a"), F.col("lead").alias("b"), "n", F.col("lead_n").alias("m")
    ).agg(F.count(F.lit(1)).alias("met"))
    first = first.filter(_can_link(F.col("n"), F.col("m"), F.col("met"))).select("a", "b")
    known = compared(first, "with-leaders")
    links = known.filter("linked").select("a", "b")
    classes = smallest_reachable(links)
    rest = compared(_open_pairs(entries.drop("lead_n"), known, classes), "open-pairs")
    links = links.unionByName(rest.filter("linked").select("a", "b"))
    classes = smallest_reachable(links)

    named = (
        rows.filter("n > 0").groupBy("set").agg(F.min("key").alias("least"))
        .join(classes, "set", "left").withColumn("class", F.coalesce("class", "set"))
    )
    smallest = named.groupBy("class").agg(F.min("least").alias("component_id"))
    component = named.select("set", "class").join(smallest, "class")
    told = rows.filter("n > 0").join(component, "set").unionByName(
        rows.filter("n = 0").withColumns({"component_id": F.col("key"), "class": F.lit(None).cast("long")})
    )
    return told.select("key", "text_hash", "n", "class", "component_id")


def jaccard_classes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`key`, n_shingles and component_id per row, as `jaccard_rows` finds them."""
    return jaccard_rows(df, text, key).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def first_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", few: int = FEW) -> DataFrame:
    """`df` with one row of each class: the one with the smallest key.

    Rows without words, null texts among them, all stay. Of rows of a class that
    repeat its smallest key, the one with the smallest hash of its text stays, and of
    rows that repeat both, the one whose values have the smallest digest. Long
    texts are hashed whole. Columns of any name are kept; an empty table gives an
    empty one. What goes, or repeats, is broadcast while it is no more than `few` rows.
    """
    rows = stored(
        jaccard_rows(df, text, key).filter(F.col("class").isNotNull())
        .groupBy("class", "component_id", "key", "text_hash").agg(F.count(F.lit(1)).alias("times")),
        "members",
    )
    # Most members are told by their key alone; only those that repeat the smallest meet by class.
    least = F.col("key").eqNullSafe(F.col("component_id"))
    kept = rows.filter(least).groupBy("class").agg(F.min(F.struct("text_hash", "times")).alias("one"))
    names = [unused(name, df.columns) for name in ("key_of", "hash_of", "gone_key", "gone_hash", "place")]
    of_key, of_hash, gone_key, gone_hash, place = names

    def named_as(found: DataFrame, label: str) -> DataFrame:
        found = found.select(F.col("key").alias(gone_key), F.col("text_hash").alias(gone_hash))
        return bounded_broadcast(stored(found, label), few)

    others = rows.filter(least).join(kept, "class").filter(F.col("text_hash") != F.col("one.text_hash"))
    gone = named_as(rows.filter(~least).select("key", "text_hash").unionByName(others.select("key", "text_hash")), "gone")
    again = rows.filter(least & (F.col("times") > 1)).join(kept, "class").filter(F.col("text_hash") == F.col("one.text_hash"))
    twice = named_as(again, "twice")
    same = F.col(of_key).eqNullSafe(F.col(gone_key)) & F.col(of_hash).eqNullSafe(F.col(gone_hash))
    told = df.withColumns({of_key: F.col(f"`{key}`"), of_hash: F.xxhash64(F.col(f"`{text}`"))})
    left = told.join(gone, same, "left_anti")
    values = digest([(F.col(f"`{field.name}`"), field.dataType) for field in df.schema.fields])
    once = top_k(left.join(twice, same, "left_semi"), [of_key, of_hash], list(values), 1, place).drop(place)
    columns = [F.col(f"`{name}`") for name in df.columns]
    return left.join(twice, same, "left_anti").unionByName(once).select(*columns)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


_ORACLE = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
        FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reached AS (
        SELECT doc_id, doc_id AS c FROM words
        UNION
        SELECT links.b, reached.c FROM reached JOIN links ON links.a = reached.doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(c) AS component_id
    FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

QUERIES = {"op5_jaccard_join": op5_jaccard_join}
ORACLES = {"op5_jaccard_join": _ORACLE}
