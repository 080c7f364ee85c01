"""Operator 12: every window of every text against every other."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from packhorse.llm import substrings as op


def expected(texts):
    """(n_words, factors, kept) per text, by counting the word sequences of all windows."""
    split = [(text or "").encode().split() for text in texts]
    windows = Counter(tuple(w[i : i + op.WINDOW]) for w in split for i in range(len(w) - op.WINDOW + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - op.WINDOW + 1):
            if windows[tuple(words[i : i + op.WINDOW])] > 1:
                gone[i : i + op.WINDOW] = [True] * op.WINDOW
        factors, i = [], 0
        while i < len(words):
            j = i
            while j < len(words) and gone[j] == gone[i]:
                j += 1
            if gone[i]:
                factors.append((i, j - i))
            i = j
        out.append((len(words), factors, b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return out


def found(spark, texts, parts=4):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = sorted(op.without_repeats(df).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == texts
    for row in rows:
        assert row.repeats.n_removed == sum(f.length for f in row.repeats.factors)
    return [(r.repeats.n_words, [tuple(f) for f in r.repeats.factors], r.repeats.kept) for r in rows]


def corpus(seed, n=60):
    """Texts that share passages of about a window's length, some with a word changed, and periodic ones."""
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passages = [[pick.choice(words) for _ in range(pick.choice([34, 35, 36, 60, 200]))] for _ in range(12)]
    texts = []
    for _ in range(n):
        text = []
        for _ in range(pick.randrange(1, 5)):
            part = list(pick.choice(passages))
            for _ in range(pick.choice([0, 0, 1, 2, 5])):
                part[pick.randrange(len(part))] = pick.choice(words)
            cut = pick.choice([0, 0, pick.randrange(len(part))])
            text += part[cut:] + [pick.choice(words) for _ in range(pick.randrange(40))]
        texts.append(pick.choice([" ", "\n", " \t"]).join(text))
    texts += ["again " * k for k in (34, 35, 36, 37, 90)] + ["on and off " * 30, "off on and " * 13]
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_by_brute_force(spark, seed):
    texts = corpus(seed)
    assert found(spark, texts) == expected(texts)


def test_pieces_do_not_show(spark, monkeypatch):
    """Texts hashed and parsed in small pieces give the same."""
    monkeypatch.setattr(op, "BYTES", 50)
    monkeypatch.setattr(op, "WINDOWS", 23)
    texts = corpus(7, 30)
    assert found(spark, texts) == expected(texts)


def test_one_passage_in_a_third_of_all_rows(spark):
    pick = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(50))
    other = [" ".join(f"x{pick.random()}" for _ in range(30)) for _ in range(300)]
    texts = [f"{o} {passage} {o[::-1]}" if k % 3 == 0 else o for k, o in enumerate(other)]
    assert found(spark, texts, 9) == expected(texts)


def test_odd_texts(spark, odd_texts):
    df = odd_texts.selectExpr("*", "1 AS id", "2 AS body", "'x' AS repeats", "4 AS _text_repeats", "5 AS anchor", "6 AS codes")
    rows = op.without_repeats(df).collect()
    assert op.without_repeats(df).columns == [*[c for c in df.columns if c != "repeats"], "repeats"]
    texts = [r.text for r in rows]
    told = [(r.repeats.n_words, [tuple(f) for f in r.repeats.factors], r.repeats.kept) for r in rows]
    assert told == expected(texts) and len(rows) == df.count()
    assert {(r.id, r.body, r._text_repeats, r.anchor, r.codes) for r in rows} == {(1, 2, 4, 5, 6)}
    assert op.without_repeats(df.limit(0)).collect() == []


def test_equal_windows_have_equal_anchors():
    pick = np.random.default_rng(3)
    passage = pick.integers(0, 50, 80)
    one = op.word_hashes(b" ".join(b"%d" % k for k in [*pick.integers(0, 50, 40), *passage, *pick.integers(0, 50, 9)]))
    two = op.word_hashes(b" ".join(b"%d" % k for k in passage))
    anchors = [np.repeat(p[0], p[3]) for p in (op.phrases(one), op.phrases(two))]
    assert (anchors[0][40 : 40 + len(anchors[1])] == anchors[1]).all()
    assert len(anchors[0]) == len(one) - op.WINDOW + 1
