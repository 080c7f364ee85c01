"""Operator 6: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import by_small_batches, give_back, held_out, in_training, table
from packhorse.llm.quality_rules import repeated_lines, repeated_words

FEATURES = (
    "log_bytes log_words word_bytes long_words distinct_words top_word same_as_last repeated lines "
    "line_words repeated_lines upper lower digits spaces bangs bars hashes other_marks sentence_marks "
    "high_bytes byte_entropy ratio title_words"
).split()


def _bytes_of(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


UPPER, LOWER, DIGITS = (_bytes_of(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
SPACES, BANGS, BARS, HASHES = (_bytes_of(x) for x in (" \t\n\x0b\x0c\r", "!?", "|<>{}[]\\", "#*$%&@~^_"))
MARKS, SENTENCE = _bytes_of("+=/\"'()-`"), _bytes_of(".,;:")


def statistics(text: str | None, squeeze: zstandard.ZstdCompressor) -> list[float]:
    """The numbers a score rests on, of the whole text; null counts as empty."""
    data = (text or "").encode()
    words = data.split()
    size, n = max(len(data), 1), max(len(words), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts / size
    some = share[share > 0]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter(map(hash, words), np.int64, len(words))
    _, times = np.unique(ids, return_counts=True)
    lines = max(data.count(b"\n") + 1, 1)
    return [
        np.log1p(len(data)), np.log1p(len(words)), float(lengths.sum()) / n, float((lengths > 15).sum()) / n,
        len(times) / n, float(times.max(initial=0)) / n, float((ids[1:] == ids[:-1]).sum()) / n,
        repeated_words(words) / n, np.log1p(lines), len(words) / lines, repeated_lines(data) / lines,
        *(float(share[group].sum()) for group in (UPPER, LOWER, DIGITS, SPACES, BANGS, BARS, HASHES, MARKS, SENTENCE)),
        float(share[128:].sum()), float(-(some * np.log2(some)).sum()),
        len(squeeze.compress(data)) / size if data else 1.0,
        sum(word[:1].isupper() for word in words) / n,
    ]


@dataclass(frozen=True)
class Settings:
    """`rows` bounds the labelled rows that the trees are fitted on."""

    rows: int = 12_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least_rows: int = 20
    l2: float = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees as flat arrays: node i has the children 2i+1 and 2i+2.

    A row goes right when its feature is above the threshold. Inner nodes come
    first, leaf values are indexed by the node less the number of inner ones.
    """

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = inner.bit_length()
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, settings: Settings) -> Trees:
    """Boosted trees for log loss; each split is chosen from histograms of gradients.

    Without rows, or with one class only, the score is the smoothed share of label 1.
    """
    inner, leaves = 2**settings.depth - 1, 2**settings.depth
    rate = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(rate / (1 - rate)))
    if len(y) < 2 * settings.least_rows or y.min() == y.max():
        none = np.zeros((0, inner))
        return Trees(start, none.astype(np.int64), none, np.zeros((0, leaves)))
    n, width, bins = len(x), x.shape[1], settings.bins
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
    flat = binned + np.arange(width) * bins
    total = np.full(n, start)
    trees = []
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(settings.depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * bins) + flat).ravel()

            def histogram(values, place=place, many=many):
                weights = None if values is None else np.repeat(values, width)
                counted = np.bincount(place, weights=weights, minlength=many * width * bins)
                return counted.reshape(many, width, bins).cumsum(axis=2)

            g, h, c = histogram(gradient), histogram(hessian), histogram(None)
            whole_g, whole_h, whole_c = g[..., -1:], h[..., -1:], c[..., -1:]
            gain = (
                g**2 / (h + settings.l2)
                + (whole_g - g) ** 2 / (whole_h - h + settings.l2)
                - whole_g**2 / (whole_h + settings.l2)
            )
            gain[(c < settings.least_rows) | (whole_c - c < settings.least_rows)] = -1
            best = gain.reshape(many, -1).argmax(axis=1)
            value = gain.reshape(many, -1).max(axis=1)
            for k in np.flatnonzero(value > 1e-6):
                j, cut = divmod(int(best[k]), bins)
                if cut < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        slot = node - inner
        g = np.bincount(slot, gradient, leaves)
        h = np.bincount(slot, hessian, leaves)
        leaf = settings.rate * g / (h + settings.l2)
        total += leaf[slot]
        trees.append((feature, threshold, leaf))
    return Trees(start, *(np.stack(part) for part in zip(*trees, strict=True)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_statistics(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for texts in batches:
        yield pd.Series([statistics(value, squeeze) for value in texts])


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings, label: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """At most `rows` labelled documents outside the held-out third, by a hash of their id.

    Repeated ids count once: with the greatest label, and the greatest statistics.
    """
    known = labels.filter(in_training("doc_id") & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    few = (
        known.groupBy("doc_id").agg(F.max(label).alias("y"))
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(29)), "doc_id").limit(settings.rows)
    )
    # Bounded by `rows`, hence the hint.
    picked = by_small_batches(docs).select("doc_id", "text").join(F.broadcast(few), "doc_id")
    told = picked.select("doc_id", "y", text_statistics(F.col("text")).alias("x"))
    once = told.groupBy("doc_id").agg(F.max(F.struct("y", "x")).alias("best"))
    rows = once.orderBy("doc_id").select("best.*").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return x, rows["y"].to_numpy(float)


def quality_score(df: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """`df` with a double `out` from 0 to 1, higher where label 1 is likelier.

    Every row gets a score from its whole text; null counts as empty. Equal
    texts score alike, an empty table gives an empty one, and a column that is
    already named `out` is replaced.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for texts in batches:
            x = np.array([statistics(value, squeeze) for value in texts], float)
            yield pd.Series(trees.probability(x.reshape(-1, len(FEATURES))))
        give_back()

    return by_small_batches(df).withColumn(out, score(F.col(text)))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents").select("doc_id", "text"), Settings()
    trees = fit_trees(*training_rows(docs, table(spark, sf_dir, "labels"), settings), settings)
    scored = quality_score(docs, trees)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op6_quality_model": op6_quality_model}
ORACLES: dict[str, str] = {}
