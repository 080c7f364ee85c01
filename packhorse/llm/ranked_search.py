"""Operator 13: ranked lexical search with documents grouped by presence masks.

One pass turns documents into short postings of the terms that items ask for,
and counts documents and terms. A second pass reads the postings in blocks. For
each item, bitmaps of its terms' documents add up to a mask per document, which
tells the item's terms that it holds. Documents with the same mask have the same
greatest score. Distinct masks are evaluated from the highest on, until the k
documents that are kept, of this block and the task's earlier ones, can not
be outdone by any mask that is left.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import by_small_batches, give_back, running_start, stored, table
from packhorse.operators.ordered import top_k

K = 10
# Characters of items that one pass over the documents answers; more items take more passes.
ITEM_CHARS = 20_000_000
# Documents, and postings, of a block.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20

# All ASCII but letters and digits parts terms; A-Z are lower-cased.
_TERM = bytes(
    c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def terms_of(text: bytes | str | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_TERM).split()


@dataclass(frozen=True)
class Items:
    """Items by place, each with its terms' numbers and how often it has them."""

    rows: list[Row]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    numbers: dict[bytes, int]


def _items(rows: list[Row]) -> Items:
    numbers: dict[bytes, int] = {}
    terms, times = [], []
    for row in rows:
        found = Counter(terms_of(row[1]))
        terms.append(np.array([numbers.setdefault(term, len(numbers)) for term in found], np.int64))
        times.append(np.array(list(found.values()), np.int64))
    return Items(rows, terms, times, numbers)


def _postings(docs: DataFrame, numbers: Broadcast, key_type: str) -> DataFrame:
    """Per document its key, number of terms, and the wanted terms with their counts; in rows
    with a `term`, how many of a task's documents hold it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, names = numbers.value.get, Counter(), None
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                found = terms_of(text)
                there = Counter(map(number, found))
                there.pop(None, None)
                held.update(there.keys())
                n.append(len(found))
                terms.append(np.fromiter(there.keys(), "<u4", len(there)).tobytes())
                counts.append(np.fromiter(there.values(), "<u4", len(there)).tobytes())
            names, kind = ["key", "n", "terms", "counts", "term", "docs"], batch.column(0).type
            nothing = pa.nulls(len(n), pa.int64())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, nothing, nothing], names=names)
        if held:
            rows = len(held)
            nothing = [pa.nulls(rows, kind), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())]
            counted = [pa.array(list(held.keys()), pa.int64()), pa.array(list(held.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays([*nothing, *counted], names=names)
        give_back()

    schema = f"key {key_type}, n long, terms binary, counts binary, term long, docs long"
    return stored(docs.mapInArrow(work, schema), "postings")


class _Block:
    """The postings of some documents, by term, with what a term adds to each document's score."""

    def __init__(self, keys: list, n: list[int], terms: list[bytes], counts: list[bytes], total: tuple[int, int]):
        self.keys = keys
        documents, length = total
        per_doc = np.array([len(t) // 4 for t in terms], np.int64)
        term = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
        tf = np.frombuffer(b"".join(counts), "<u4").astype(np.int64)
        m = 25 + 75 * np.array(n, np.int64) * documents // length
        doc = np.repeat(np.arange(len(n)), per_doc)
        part = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        order = np.argsort(term, kind="stable")
        self.docs, self.parts, term = doc[order], part[order], term[order]
        there, first = np.unique(term, return_index=True)
        ends = np.append(first, len(term))[1:]
        self.ends = {t: (a, b) for t, a, b in zip(there.tolist(), first.tolist(), ends.tolist(), strict=True)}

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        start, end = self.ends[term]
        return self.docs[start:end], self.parts[start:end]

    def masks(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The documents with one of the terms, and the mask of each, a bit per term."""
        bits = np.zeros((-(-len(terms) // 64), len(self.keys)), np.uint64)
        for k, term in enumerate(terms):
            bits[k // 64, self.of(term)[0]] |= np.uint64(1 << k % 64)
        docs = np.flatnonzero(bits.any(axis=0))
        return docs, bits[:, docs]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """`best` (score, negative, then key order and key), with what of this block belongs to the k first."""
        here = [(t, w) for t, w in zip(terms.tolist(), weights.tolist(), strict=True) if w > 0 and t in self.ends]
        if not here:
            return best
        docs, bits = self.masks([t for t, _ in here])
        distinct, group = np.unique(bits, axis=1, return_inverse=True)
        group = group.reshape(-1)
        greatest = np.zeros(distinct.shape[1], np.int64)
        for k_th, (term, weight) in enumerate(here):
            has = (distinct[k_th // 64] >> np.uint64(k_th % 64) & np.uint64(1)).astype(bool)
            greatest[has] += weight * int(self.of(term)[1].max())
        by_bound = np.argsort(-greatest, kind="stable")
        members = docs[np.argsort(group, kind="stable")]
        sizes = np.bincount(group, minlength=len(greatest))
        starts = np.cumsum(sizes) - sizes
        at, step = 0, 16
        while at < len(by_bound):
            least = -best[-1][0] if len(best) == k else 1
            masks = by_bound[at : at + step]
            masks = masks[greatest[masks] >= least]
            if not len(masks):
                break
            chosen = np.sort(np.concatenate([members[starts[g] : starts[g] + sizes[g]] for g in masks.tolist()]))
            best = self._merged(best, chosen, here, least, k)
            at, step = at + step, 2 * step
        return best

    def _merged(self, best: list[tuple], chosen: np.ndarray, here: list[tuple[int, int]], least: int, k: int) -> list[tuple]:
        score = np.zeros(len(chosen), np.int64)
        for term, weight in here:
            docs, parts = self.of(term)
            place = np.minimum(np.searchsorted(docs, chosen), len(docs) - 1)
            score += np.where(docs[place] == chosen, weight * parts[place], 0)
        good = np.flatnonzero(score >= least)
        keys = [self.keys[doc] for doc in chosen[good].tolist()]
        new = [(-s, key is None, key) for s, key in zip(score[good].tolist(), keys, strict=True)]
        return sorted([*best, *new], key=lambda row: (row[0], row[1], 0 if row[2] is None else row[2]))[:k]


def _blocks(batches: Iterator[pa.RecordBatch], total: tuple[int, int]) -> Iterator[_Block]:
    held: list[list] = [[], [], [], []]
    size = 0
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            for column, value in zip(held, row, strict=True):
                column.append(value)
            size += len(row[2]) // 4
            if len(held[0]) >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                yield _Block(*held, total)
                held, size = [[], [], [], []], 0
    if held[0]:
        yield _Block(*held, total)


def _weights(items: Items, documents: int, holding: dict[int, int]) -> list[np.ndarray]:
    def weight(term: int) -> int:
        return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(term, 0) + 1)))

    return [
        np.array([weight(t) * c for t, c in zip(terms.tolist(), times.tolist(), strict=True)], np.int64)
        for terms, times in zip(items.terms, items.times, strict=True)
    ]


def _found(docs: DataFrame, items: Items, k: int, key_type: str) -> DataFrame | None:
    """Per task and item the k best documents: place of the item, key and score."""
    context = docs.sparkSession.sparkContext
    postings = _postings(docs, context.broadcast(items.numbers), key_type)
    of_docs = postings.filter("term IS NULL")
    documents, length = of_docs.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not length:
        return None
    # One row per term that an item asks for.
    counted = postings.filter("term IS NOT NULL").groupBy("term").agg(F.sum("docs")).collect()
    wanted = context.broadcast((items.terms, _weights(items, documents, dict(counted))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = wanted.value
        best: list[list[tuple]] = [[] for _ in terms]
        kind = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                yield batch

        for block in _blocks(typed(), (documents, length)):
            for item in range(len(terms)):
                best[item] = block.search(terms[item], weights[item], best[item], k)
        rows = [(item, key, -score) for item, kept in enumerate(best) for score, _, key in kept]
        if rows:
            places, keys, scores = zip(*rows, strict=True)
            columns = [pa.array(places, pa.int64()), pa.array(keys, kind), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "key", "score"])
        give_back()

    found = of_docs.select("key", "n", "terms", "counts").mapInArrow(work, f"place long, key {key_type}, score long")
    return stored(found, "found")


def _groups(items: DataFrame, item_key: str, item_text: str, most_chars: int) -> Iterator[list[Row]]:
    """Items in lists of at most `most_chars` characters, and one item more."""
    rows = items.select(
        F.col(item_key).alias("key"), F.col(item_text).alias("text"), F.coalesce(F.length(item_text), F.lit(0)).alias("chars")
    )
    total = rows.agg(F.sum("chars") + F.count(F.lit(1))).first()[0] or 0
    if total <= most_chars:
        yield rows.select("key", "text").collect()
        return
    numbered = rows.withColumns({"size": F.col("chars") + 1, "row": F.monotonically_increasing_id()})
    started = running_start(stored(numbered, "items"), ["row"], "size", "start", "items-by-row")
    grouped = stored(started.withColumn("group", F.floor(F.col("start") / most_chars)), "item-groups")
    for group in range(1 + total // most_chars):
        yield grouped.filter(F.col("group") == group).select("key", "text").collect()


def search(
    docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", most_chars: int = ITEM_CHARS,
) -> DataFrame:
    """The k documents with the highest scores above 0 for each item: item_key, rank, key, score.

    Every row of `items` is an item, repeated ones, too, whose ranks are each from 1.
    Terms, weights and scores are the contract's. Null and empty texts, of
    documents or items, have no terms and are not found, nor find any. Equal scores go
    by key, null keys last; rows that repeat key and text are ranked one after the
    other. Texts are read whole; other columns are left aside, whatever their
    names; empty tables give an empty one. Keys are whole numbers or strings.
    """
    key_type, item_type = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType
    bodies = by_small_batches(docs).select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    spark, results = docs.sparkSession, []
    for rows in _groups(items, item_key, item_text, most_chars):
        asked = _items(rows)
        found = _found(bodies, asked, k, key_type)
        if found is None:
            break
        names = spark.createDataFrame(
            [(place, row[0]) for place, row in enumerate(rows)],
            T.StructType([T.StructField("place", T.LongType()), T.StructField("item", item_type)]),
        )
        ranked = top_k(found, ["place"], [F.desc("score"), F.asc_nulls_last("key")], k)
        # One short row per item of a group, whose size is bounded.
        results.append(ranked.join(F.broadcast(names), "place"))
    schema = T.StructType([
        T.StructField(item_key, item_type), T.StructField("rank", T.IntegerType()),
        T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType()),
    ])
    out = spark.createDataFrame([], schema)
    for one in results:
        out = out.unionByName(one.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score"))
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TOKENS = r"""
    SELECT r, id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT row_number() OVER () AS r, {id} AS id, text FROM {table})
"""
_ORACLE = f"""
    WITH tf AS (SELECT r, id, t, count(*) AS tf FROM ({_TOKENS.format(id="doc_id", table="documents")}) GROUP BY r, id, t),
    asked AS (SELECT r AS item, id AS item_id, t, count(*) AS times
              FROM ({_TOKENS.format(id="item_id", table="benchmark")}) GROUP BY r, id, t),
    lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
    weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM tf, total GROUP BY t, docs),
    scores AS (
        SELECT item, item_id, id AS doc_id, r, sum(times * w
            * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))))::BIGINT AS score
        FROM asked JOIN tf USING (t) JOIN weights USING (t) JOIN lengths USING (r), total
        GROUP BY item, item_id, id, r)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {K}
"""

QUERIES = {"op13_ranked_search": op13_ranked_search}
ORACLES = {"op13_ranked_search": _ORACLE}
