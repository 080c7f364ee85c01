"""Operator 13: every score of every document, by a loop."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from packhorse.llm import ranked_search as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def expected(docs, items, k=op.K):
    """Sorted (item, rank, key, score) of lists of (key, text)."""
    found = [(key, Counter(terms(text))) for key, text in docs]
    lengths = [sum(c.values()) for _, c in found]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    held = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for (key, counts), n in zip(found, lengths, strict=True):
            score = 0
            for term in terms(text):
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1)))
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += w * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(scores, key=lambda r: r[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **settings):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS n", "3 AS place").repartition(5)
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS chars", "2 AS start")
    df = op.search(docs, items, **settings)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n=300, words=150):
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    docs = [(k, " ".join(pick.choices(vocabulary, weights, k=pick.randrange(1, 60)))) for k in range(n)]
    items = [(k, " ".join(pick.choices(vocabulary, k=pick.choice([1, 2, 8, 30, 200])))) for k in range(25)]
    return docs + [(n + k, docs[k][1]) for k in range(0, n, 3)], items


@pytest.mark.parametrize(("seed", "k"), [(1, 10), (2, 1), (3, 400)])
def test_by_brute_force(spark, seed, k):
    docs, items = corpus(seed)
    assert found(spark, docs, items, k=k) == expected(docs, items, k)


def test_blocks_and_groups_do_not_show(spark, monkeypatch):
    """Blocks of a few documents, and a pass for every few items."""
    docs, items = corpus(4)
    monkeypatch.setattr(op, "BLOCK_DOCS", 7)
    monkeypatch.setattr(op, "BLOCK_POSTINGS", 60)
    assert found(spark, docs, items, most_chars=700) == expected(docs, items)


def test_masks_are_left_out_only_below_the_worst_kept(spark):
    """A block of equal documents, and one better one behind the masks that are looked at first."""
    docs = [(k, "common words here") for k in range(500)] + [(500, "rare " * 9), (501, "rare common"), (502, "words " * 50)]
    items = [(1, "rare common words"), (2, "words words here"), (3, "rare")]
    assert found(spark, docs, items) == expected(docs, items)


def test_odd_texts(spark, odd_texts):
    docs = [(r.doc_id, r.text) for r in odd_texts.collect()]
    items = [(1, None), (2, ""), (None, "the same WORDS"), (3, "é ß 日本語 İ"), (3, "word"), (3, "word"), (4, "A\x00b c"), (5, "#$%")]
    assert found(spark, docs, items) == expected(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(5, 5)
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert op.search(none, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert op.search(spark.createDataFrame(docs, "doc_id long, text string"), no_items).collect() == []
    assert found(spark, [(1, None), (2, "?!")], items) == []


def test_string_keys(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("x", "two")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in op.search(docs, items).orderBy("rank").collect()] == [
        ("x", 1, "a"), ("x", 2, "b"), ("x", 3, None)
    ]
