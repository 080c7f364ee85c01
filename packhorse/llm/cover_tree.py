"""Operator 4: exact top-k inner products by dual-tree search over a cover tree.

Queries and candidates hang in one tree. A pair of nodes is opened only while
the greatest inner product that its covering radii allow can still enter the
results of some query below: while it reaches the worst of their kth scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packhorse.llm.common import stored, table


@dataclass(frozen=True)
class Settings:
    """`sample` rows fit the tree's centres and give every query its first kth score.

    The tree has at most `most_leaves` leaves, about one for `leaf_rows` rows.
    Leaves are read in blocks of about `block` candidates and `query_block` queries.
    """

    k: int = 5
    scale: int = 256
    sample: int = 8192
    most_leaves: int = 256
    leaf_rows: int = 2048
    block: int = 4096
    query_block: int = 512


@dataclass(frozen=True)
class Tree:
    """Nested nets: node i is a centre; its parent came before it and covers it.

    `children[i]` are the nodes that i covers besides its own leaf. Nodes come in
    the order of farthest-first traversal, so centres at the first m places are
    apart by at least the distance at which the next one was taken.
    """

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]


def quantised(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """`df` with `_v`, the array of floor(scale * x), for the vectors that take part."""
    x = F.transform(F.col(vector), lambda one: one.cast("double"))
    usable = F.col(vector).isNotNull() & F.forall(x, lambda one: one.isNotNull() & ~F.isnan(one) & (F.abs(one) < float("inf")))
    whole = F.transform(x, lambda one: F.floor(one * scale).cast("long"))
    return df.filter(F.coalesce(usable, F.lit(False))).withColumn("_v", whole)


def fit(points: np.ndarray, leaves: int) -> Tree:
    """A cover tree over centres chosen farthest first; each hangs below the nearest earlier one that covers it."""
    if not len(points):
        return Tree(np.zeros((1, 0)), ((),))
    chosen, near = [0], np.linalg.norm(points - points[0], axis=1)
    taken = [math.inf]
    while len(chosen) < leaves and near.max() > 0:
        next_one = int(near.argmax())
        taken.append(float(near[next_one]))
        chosen.append(next_one)
        near = np.minimum(near, np.linalg.norm(points - points[next_one], axis=1))
    centres = points[chosen]
    below: list[list[int]] = [[] for _ in chosen]
    for i in range(1, len(chosen)):
        # Level l of a cover tree: centres taken at a distance above 2^l. The
        # parent is the nearest centre of a level above.
        above = [j for j in range(i) if _level(taken[j]) > _level(taken[i])] or [0]
        gap = np.linalg.norm(centres[above] - centres[i], axis=1)
        below[above[int(gap.argmin())]].append(i)
    return Tree(centres, tuple(tuple(one) for one in below))


def _level(distance: float) -> float:
    return math.inf if math.isinf(distance) else math.ceil(math.log2(distance))


@dataclass
class Covers:
    """Per node the covering radius of what hangs below it; -inf where nothing does."""

    radius: np.ndarray

    @classmethod
    def of(cls, tree: Tree, own: np.ndarray) -> Covers:
        radius = own.copy()
        for i in reversed(range(len(radius))):
            for child in tree.children[i]:
                if radius[child] >= 0:
                    gap = float(np.linalg.norm(tree.centres[i] - tree.centres[child]))
                    radius[i] = max(radius[i], gap + radius[child])
        return cls(radius)


def surviving(tree: Tree, queries: np.ndarray, worst: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of leaves (queries, candidates) that the dual traversal cannot prune.

    `queries` and `rows` are the radii of what each leaf itself holds, `worst` the
    worst kth score of its queries. Leaf i is the part of node i that none of its
    children takes.
    """
    q, r = Covers.of(tree, queries).radius, Covers.of(tree, rows).radius
    low = worst.copy()
    for i in reversed(range(len(low))):
        for child in tree.children[i]:
            low[i] = min(low[i], low[child])
    norms = np.linalg.norm(tree.centres, axis=1)
    products = tree.centres @ tree.centres.T

    def most(a: int, ra: float, b: int, rb: float) -> float:
        bound = products[a, b] + ra * norms[b] + rb * norms[a] + ra * rb
        return bound + 1e-6 * abs(bound) + 1e-3

    found, todo = [], [(0, True, 0, True)]
    while todo:
        a, a_whole, b, b_whole = todo.pop()
        ra, rb = (q if a_whole else queries)[a], (r if b_whole else rows)[b]
        if ra < 0 or rb < 0 or most(a, ra, b, rb) < (low if a_whole else worst)[a]:
            continue
        if not a_whole and not b_whole:
            found.append((a, b))
        elif a_whole and (ra >= rb or not b_whole):
            todo.append((a, False, b, b_whole))
            todo.extend((child, True, b, b_whole) for child in tree.children[a])
        else:
            todo.append((a, a_whole, b, False))
            todo.extend((a, a_whole, child, True) for child in tree.children[b])
    return found


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by floating point where every sum is exact in it."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _pack(rows: np.ndarray) -> bytes:
    for kind in ("<i2", "<i4"):
        if np.abs(rows).max(initial=0) <= np.iinfo(kind).max:
            return kind.encode() + rows.astype(kind).tobytes()
    return b"<i8" + rows.astype("<i8").tobytes()


def _unpack(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, data[:3].decode(), offset=3).reshape(rows, -1)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), dim)


def _top(queries: pd.DataFrame, rows: np.ndarray, ids: np.ndarray, nulls: np.ndarray, scores: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows per query (row, id), its own row left out; null ids rank last among equals."""
    parts, ranked = [], np.where(nulls, np.iinfo(np.int64).max, ids)
    for value, row, name in zip(scores, queries["row"], queries["id"], strict=True):
        some = np.arange(len(value))
        if len(value) > k + 1:
            least = np.partition(value, len(value) - k - 1)[len(value) - k - 1]
            some = np.flatnonzero(value >= least)
        some = some[rows[some] != row]
        best = some[np.lexsort((rows[some], ranked[some], -value[some]))[:k]]
        found = {"row": rows[best], "vec_id": pd.arrays.IntegerArray(ids[best], nulls[best]), "score": value[best]}
        parts.append(pd.DataFrame({"query_row": row, "query_id": name, **found}))
    return pd.concat(parts)


def _search_one_size(rows: DataFrame, dim: int, settings: Settings) -> DataFrame:
    """Searches among stored vectors of one dimension: row, id, is_query, _v."""
    spark, k = rows.sparkSession, settings.k
    drawn = rows.orderBy(F.xxhash64("row", F.lit(41)), "row").limit(settings.sample).select("row", "_v").toPandas()
    points, drawn_rows = _matrix(drawn["_v"], dim), drawn["row"].to_numpy(np.int64)
    count = rows.count()
    leaves = min(settings.most_leaves, max(1, math.ceil(count / settings.leaf_rows)))
    tree = fit(points.astype(float), leaves)
    given = spark.sparkContext.broadcast((points, drawn_rows, tree.centres))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, drawn_rows, centres = given.value
        for batch in batches:
            v = _matrix(batch["_v"], dim)
            x = v.astype(float)
            square = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None] - 2 * x @ centres.T
            leaf = square.argmin(axis=1)
            far = np.linalg.norm(x - centres[leaf], axis=1)
            worst = np.full(len(batch), np.nan)
            asks = np.flatnonzero(batch["is_query"])
            own = batch["row"].to_numpy(np.int64)
            for i in asks:
                value = _products(v[i : i + 1], points)[0][drawn_rows != own[i]]
                worst[i] = np.partition(value, len(value) - k)[len(value) - k] if len(value) >= k else -np.inf
            yield pd.DataFrame(
                {
                    "row": own, "id": batch["id"].astype("Int64"), "is_query": batch["is_query"], "leaf": leaf,
                    "far": far, "worst": worst, "_v": batch["_v"],
                }
            )

    placed = stored(
        rows.mapInPandas(assign, "row long, id long, is_query boolean, leaf long, far double, worst double, _v array<long>"),
        "leaves",
    )
    asked = F.col("is_query")
    stats = {
        row["leaf"]: row
        for row in placed.groupBy("leaf").agg(
            F.count(F.lit(1)).alias("rows"), F.max("far").alias("far"), F.count_if(asked).alias("queries"),
            F.max(F.when(asked, F.col("far"))).alias("query_far"), F.min(F.when(asked, F.col("worst"))).alias("worst"),
        ).collect()
    }
    size = len(tree.centres)
    none = -math.inf

    def per_leaf(name: str, missing: float) -> np.ndarray:
        values = [stats[i][name] if i in stats else None for i in range(size)]
        return np.array([missing if value is None else float(value) for value in values])

    found = surviving(tree, per_leaf("query_far", none), per_leaf("worst", math.inf), per_leaf("far", none))
    # No more than the square of `most_leaves`.
    pairs = spark.createDataFrame(found, "query_leaf long, leaf long")

    def blocks(side: DataFrame, rows_name: str, length: int) -> DataFrame:
        """The rows of a leaf in blocks, each one row with a matrix."""
        number = {leaf: max(1, math.ceil(row[rows_name] / length)) for leaf, row in stats.items()}
        parts = spark.createDataFrame([(int(a), int(b)) for a, b in number.items()], "leaf long, parts long")

        def pack(group: pd.DataFrame) -> pd.DataFrame:
            ids = group["id"].astype("Int64")
            return pd.DataFrame(
                {
                    "leaf": [group["leaf"].iloc[0]], "block": [group["block"].iloc[0]], "ids": [ids.fillna(0).tolist()],
                    "nulls": [ids.isna().tolist()], "rows": [group["row"].tolist()], "data": [_pack(_matrix(group["_v"], dim))],
                }
            )

        dealt = side.join(F.broadcast(parts), "leaf").withColumn("block", F.pmod(F.xxhash64("row"), "parts"))
        schema = "leaf long, block long, ids array<long>, nulls array<boolean>, rows array<long>, data binary"
        return stored(dealt.groupBy("leaf", "block").applyInPandas(pack, schema), "blocks")

    candidates = blocks(placed, "rows", settings.block)
    queries = blocks(placed.filter("is_query"), "queries", settings.query_block)
    asks = queries.select(*(F.col(name).alias(f"q_{name}") for name in queries.columns))
    wanted = candidates.select("leaf", "block").join(F.broadcast(pairs), "leaf")
    meetings = (
        wanted.join(asks, F.col("query_leaf") == F.col("q_leaf"))
        .join(candidates, ["leaf", "block"])
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for one in batch.itertuples():
                a, b = _unpack(one.q_data, len(one.q_rows)), _unpack(one.data, len(one.rows))
                asks = pd.DataFrame({"row": one.q_rows, "id": one.q_ids})
                yield _top(asks, one.rows, one.ids, one.nulls, _products(a, b), k)

    best = meetings.mapInPandas(score, "query_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def search(df: DataFrame, is_query, settings: Settings | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every row where `is_query` holds its k best other rows: query_id, rank, vec_id, score.

    Scores are inner products of vectors turned into integers and must fit a
    long. Equal scores go to the smaller key, a null key last; repeated rows and
    keys are rows of their own. Null vectors and those with a null or non-finite
    component take no part; vectors meet those of their own length only. A query
    has fewer results where there are fewer candidates; an empty table gives none.
    Other columns are left aside, whatever their names.
    """
    settings = settings or Settings()
    named = df.select(
        F.col(key).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), F.col(vector).alias("vector")
    )
    rows = stored(
        quantised(named, "vector", settings.scale)
        .select("id", "is_query", "_v", F.size("_v").alias("dim"), F.monotonically_increasing_id().alias("row")),
        "vectors",
    )
    # As many as there are lengths of vectors, one as a rule.
    sizes = [row["dim"] for row in rows.groupBy("dim").agg(F.max("is_query").alias("asked")).filter("asked").collect()]
    results = [_search_one_size(rows.filter(F.col("dim") == dim).drop("dim"), dim, settings) for dim in sorted(sizes)]
    if not results:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    whole = results[0]
    for one in results[1:]:
        whole = whole.unionByName(one)
    return whole


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_ORACLE = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

QUERIES = {"op4_cover_tree": op4_cover_tree}
ORACLES = {"op4_cover_tree": _ORACLE}
