"""Operator 5 against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packhorse.llm import jaccard_join, shingles


def shingle_words(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes_of(rows):
    """Smallest key reachable, from all pairs."""
    sets = [shingle_words(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows)), key=str)


def made_rows(seed, n):
    """Groups of copies at all distances around the threshold, chains, shared passages, and short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 3000)}"
    passage = [word() for _ in range(40)]
    rows, key = [], 0
    while key < n:
        base = [word() for _ in range(draw.choice([3, 6, 20, 60, 150]))]
        if draw.random() < 0.4:
            base += passage
        text = base
        for _ in range(draw.choice([1, 1, 2, 5, 12])):
            rows.append((key, " ".join(text)))
            key += 1
            text = list(text if draw.random() < 0.5 else base)
            for _ in range(draw.randint(0, max(1, len(text) // 20))):
                text[draw.randrange(len(text))] = word()
            if draw.random() < 0.2:
                text = text + [word() for _ in range(len(text) // 8)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "length"), [(1, 4096), (2, 3), (3, 1)])
def test_equals_all_pairs(spark, monkeypatch, seed, length):
    """Also where long lists are cut into blocks."""
    monkeypatch.setattr(jaccard_join, "LIST", length)
    rows = made_rows(seed, 500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(row) for row in jaccard_join.jaccard_classes(df).collect()]
    assert sorted(got, key=str) == classes_of(rows)


def test_at_the_threshold(spark):
    """4 of 5 shingles in common link, just less does not."""
    base = [f"a{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join([*base, "y", "z"]))]
    # 8 of 10; 9 of 11; and 2 with 3: 8 of 12
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.jaccard_classes(df).collect())) == [(1, 9, 1), (2, 9, 1), (3, 11, 1)]
    assert sorted(map(tuple, jaccard_join.jaccard_classes(df.filter("doc_id > 1")).collect())) == [(2, 9, 2), (3, 11, 3)]


def test_one_group_in_many_tasks(spark):
    """A large group of near copies makes no more pairs than it has members, give or take a few."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for key in range(600):
        text = list(base)
        text[draw.randrange(300)] = f"own{key}"
        rows.append((key, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    made = []
    real = jaccard_join._verified

    def counted(pairs, sets, label):
        made.append(pairs.count())
        return real(pairs, sets, label)

    jaccard_join._verified = counted
    try:
        got = jaccard_join.jaccard_classes(df).collect()
    finally:
        jaccard_join._verified = real
    assert {row.component_id for row in got} == {0} and sum(made) < 4 * 600


def test_odd_texts(spark, odd_texts):
    got = jaccard_join.jaccard_classes(odd_texts)
    want = classes_of([(row.doc_id, row.text) for row in odd_texts.collect()])
    # A row without words is its own component.
    want = sorted(((k, n, k if n == 0 else c) for k, n, c in want), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert jaccard_join.jaccard_classes(odd_texts.limit(0)).count() == 0


def test_first_of_each(spark, odd_texts):
    rows = made_rows(7, 300)
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, _class string").repartition(4)
    kept = jaccard_join.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted({c for _, _, c in classes_of(rows)})
    left = jaccard_join.first_of_each(odd_texts).collect()
    assert sorted(str(row.doc_id) for row in left) == sorted(["0", "1", "2", "3", "4", "6", "7", "8", "9", "10", "None"])
    assert jaccard_join.first_of_each(odd_texts.limit(0)).count() == 0


def test_one_of_rows_that_repeat_their_key(spark):
    """Names that look like the operator's own, keys with several texts, and rows that differ in other columns only."""
    text, near = " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k}" for k in range(98))
    rows = [(1, text, "x", 1), (1, text, "y", 2), (1, near, "z", 3), (2, text, "u", 4), (None, near, "v", 5), (3, "alone", "x", 6), (3, "alone", "x", 6)]
    schema = "doc_id long, text string, _key string, _hash int"
    kept = [sorted(map(tuple, jaccard_join.first_of_each(spark.createDataFrame(rows[::step], schema).repartition(n)).collect()))
            for step, n in ((1, 1), (-1, 3))]
    assert kept[0] == kept[1] and len(kept[0]) == 2
    assert kept[0][1] == (3, "alone", "x", 6) and kept[0][0] in rows[:3]


def test_shingle_sets():
    assert len(shingles.shingle_set(None)) == len(shingles.shingle_set(" \n")) == 0
    assert (shingles.shingle_set("A b C") == shingles.shingle_set("a\tB  c")).all()
    assert len(shingles.shingle_set("a b c d e")) == 1 and len(shingles.shingle_set("a a a a a a a")) == 1
    assert set(shingles.shingle_set("b c d e f")) < set(shingles.shingle_set("a b c d e f g"))
    assert shingles.set_id(np.zeros(0, np.uint64)) == 0


def test_bucket_counts(spark):
    rows = [(i, f"only here {i} and there {i} so it goes", i) for i in range(50)] + [(99, None, 0)]
    df = spark.createDataFrame(rows, "key long, text string, text_hash long").repartition(4)
    counts = shingles.bucket_counts(shingles.scan(df, "scan"))
    want = np.zeros_like(counts)
    for _, text, _ in rows:
        want[np.unique(shingles.bucket_of(shingles.shingle_set(text)))] += 1
    assert (counts == want).all()
    assert shingles.bucket_counts(shingles.scan(df.filter(F.lit(False)), "scan")).sum() == 0
