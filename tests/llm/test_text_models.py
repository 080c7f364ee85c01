"""Operators 6, 7 and 10: counts by brute force, models by held-out accuracy, odd inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from packhorse.llm import language_id, quality_model, quality_rules
from packhorse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    """The base rules, character by character."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def band(text, low_high):
    data = text.encode()
    _, low, high = [one for one in low_high if one[0] <= len(data)][-1]
    return low <= len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data) <= high


def test_quality_rules_by_brute_force(spark, documents):
    texts = {row.doc_id: row.text for row in documents[1]}
    rows = QUERIES["op7_quality_rules"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        *counts, failed = base_counts(texts[row.doc_id])
        assert [row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words] == counts
        assert row.base_failed is failed
        if row.kept:
            assert not failed and band(texts[row.doc_id], quality_rules.WHOLE_BANDS)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [row for row in rows if labels.get(row.doc_id) == 1 and not row.base_failed]
    assert all(row.kept for row in clean)


def ratio(part):
    return len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)


def test_verdicts_by_brute_force(spark, documents):
    """Kept if and only if the base rules, the whole text and enough chunks say so."""
    texts = {row.doc_id: row.text for row in documents[1]}
    wide, wider, tail = quality_rules.WIDE, quality_rules.WIDER, quality_rules.LEAST_TAIL
    for row in QUERIES["op7_quality_rules"](spark, FOLDER).collect():
        data = texts[row.doc_id].encode()
        more = wider if len(data) >= wide * len(texts[row.doc_id]) else 0
        parts = [data[at : at + 4096] for at in range(0, len(data), 4096)]
        good = []
        for part in parts if len(data) >= 4096 else []:
            if len(part) == 4096:
                good.append(0.20 <= ratio(part) <= 0.72 + more)
            elif len(part) >= tail:
                _, low, high = [one for one in quality_rules.WHOLE_BANDS if one[0] <= len(part)][-1]
                good.append(low <= ratio(part) <= high + more)
        _, low, high = [one for one in quality_rules.WHOLE_BANDS if one[0] <= len(data)][-1]
        inside = not data or low <= ratio(data) <= high + more
        assert (row.n_chunks, row.n_bad_chunks) == (len(good), good.count(False))
        assert row.kept is (not row.base_failed and inside and 4 * good.count(False) <= len(good))


def test_scripts_and_mixtures(spark):
    """Clean prose of scripts with few and with thousands of signs stays; base64 in a third of a text does not."""
    draw = np.random.default_rng(5)

    def prose(signs, sizes, words, n):
        # Zipf-like words of a script, as in prose, parted by spaces.
        known = ["".join(draw.choice(list(signs), draw.choice(sizes))) for _ in range(words)]
        weights = 1 / np.arange(2, words + 2)
        return " ".join(draw.choice(known, n, p=weights / weights.sum()))

    signs = {
        "Cyrillic": map(chr, range(0x430, 0x450)), "Arabic": map(chr, range(0x627, 0x64B)), "Greek": map(chr, range(0x3B1, 0x3CA)),
        "Devanagari": map(chr, range(0x905, 0x93A)),
    }
    rows = [(f"{name} {n}", prose(list(one), [1, 3, 5, 7], 4000, n)) for name, one in ((k, list(v)) for k, v in signs.items()) for n in (60, 300, 3000)]
    han = [chr(c) for c in draw.permutation(np.arange(0x4E00, 0x9FA0))[:3500]]
    weights = 1 / np.arange(20, 3520)
    weights /= weights.sum()
    for n in (400, 1500, 9000):
        text = "".join(draw.choice(han, n, p=weights))
        rows.append((f"Han {n}", " ".join(text[i : i + 12] for i in range(0, n, 12))))
    got = {r.k: r.quality for r in quality_rules.quality_rules(spark.createDataFrame(rows, "k string, text string")).collect()}
    assert [k for k, q in got.items() if not q.kept] == []
    latin = prose("abcdefghijklmnopqrstuvwxyz", [2, 4, 6, 8], 4000, 3000)
    mixed = []
    for size in (12_000, 24_576, 50_000):
        for share in (0.35, 0.6):
            data = base64.b64encode(draw.bytes(int(size * share * 0.75))).decode()
            data = " ".join(data[i : i + 60] for i in range(0, len(data), 60))
            mixed.append((f"{size} {share}", (latin * 5)[: int(size * (1 - share))] + " " + data))
    told = {r.k: r.quality.kept for r in quality_rules.quality_rules(spark.createDataFrame(mixed, "k string, text string")).collect()}
    assert not any(told.values())


def test_compression_bands(spark):
    prose = " ".join(WORD.findall(open(quality_rules.__file__).read()))[:3000]
    noise = "".join(chr(33 + b % 90) for b in np.random.default_rng(1).integers(0, 90, 6000))
    noise = " ".join(noise[i : i + 8] for i in range(0, 6000, 8))
    lines = " ".join(f"row {i % 7} of the list" for i in range(600))
    # One chunk of noise among four of prose is not enough, four of it are.
    pages = [" ".join(prose.split()[k:] + prose.split()[:k]) for k in range(0, 200, 40)]
    rows = [("prose", prose), ("noise", noise), ("lines", lines), ("mixed", " ".join(pages)[: 3 * 4096] + noise[:4096]), ("most", prose[:100] + noise + noise[::-1])]
    got = {r.k: r.quality for r in quality_rules.quality_rules(spark.createDataFrame(rows, "k string, text string")).collect()}
    assert {k: v.kept for k, v in got.items() if k != "mixed"} == {"prose": True, "noise": False, "lines": False, "most": False}
    assert got["noise"].ratio > 0.7 and got["lines"].base_failed
    assert (got["mixed"].n_chunks, got["mixed"].n_bad_chunks) == (4, 1)


def statistics_by_hand(text):
    """The features one by one, from loops over words, lines and bytes."""
    data = (text or "").encode()
    words = re.findall(rb"[^ \t\n\x0b\x0c\r]+", data)
    size, n, lines = max(1, len(data)), max(1, len(words)), data.split(b"\n")
    times = Counter(words)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    full = [line for line in lines if re.search(rb"[^ \t\n\x0b\x0c\r]", line)]

    def share(chars):
        return sum(data.count(c.encode()) for c in chars) / size

    classes = [
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\n\x0b\x0c\r", "!?", "|<>{}[]\\", "#*$%&@~^_",
        "+=/\"'()-`", ".,;:",
    ]
    return [
        math.log(1 + len(data)), math.log(1 + len(words)), sum(map(len, words)) / n, sum(len(w) > 15 for w in words) / n,
        len(times) / n, max(times.values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(covered) / n, math.log(1 + len(lines)), len(words) / len(lines), (len(full) - len(set(full))) / len(lines),
        *map(share, classes), sum(b > 127 for b in data) / size,
        -sum(k / size * math.log2(k / size) for k in Counter(data).values()), ratio(data) if data else 1.0,
        sum(w[:1].isupper() for w in words) / n,
    ]


def test_statistics_by_brute_force(documents, odd_texts):
    squeeze = zstandard.ZstdCompressor(level=3)
    texts = [row.text for row in documents[1][:200]] + [row.text for row in odd_texts.collect()]
    for text in texts:
        got = quality_model.statistics(text, squeeze)
        assert len(got) == len(quality_model.FEATURES)
        assert got == pytest.approx(statistics_by_hand(text), rel=1e-9, abs=1e-12)


def test_quality_model_held_out(spark):
    rows = QUERIES["op6_quality_model"](spark, FOLDER).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    judged = [(row.predicted, labels[row.doc_id]) for row in rows if row.held_out and row.doc_id in labels]
    assert len(judged) > 100 and sum(a == b for a, b in judged) >= 0.95 * len(judged)


def test_held_out_labels_are_not_learned(spark):
    """Turning every held-out label round changes no score."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    settings = quality_model.Settings(trees=5)
    a, b = (quality_model.training_rows(docs, one, settings) for one in (labels, turned))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_trees_against_row_by_row():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality_model.fit_trees(x, y, quality_model.Settings(trees=40, depth=3))
    score = trees.probability(x)
    assert ((score >= 0.5) == y).mean() > 0.95
    inner = trees.feature.shape[1]
    for row, got in zip(x[:50], score[:50], strict=True):
        total = trees.start
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < inner:
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - inner]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))
    for one in (np.zeros(0), np.ones(100)):
        flat = quality_model.fit_trees(x[: len(one)], one, quality_model.Settings())
        assert len(set(flat.probability(x))) == 1 and (flat.probability(x)[0] > 0.9) == (len(one) > 0)


def test_language_held_out(spark, documents):
    langs = {row.doc_id: row.lang for row in documents[1]}
    rows = QUERIES["op10_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(langs) and {row.lang_pred for row in rows} <= set(langs.values()) | {"und"}
    assert all(0 <= row.score <= 1 for row in rows)
    held = [row for row in rows if row.held_out]
    assert {row.held_out for row in rows if zlib.crc32(str(row.doc_id).encode()) % 3 == 1} == {True}
    assert sum(row.lang_pred == langs[row.doc_id] for row in held) >= 0.95 * len(held)


def test_sizes_and_choice_by_brute_force(spark, documents):
    """Every size anew, one compressor a text and language, and the choice among them."""
    settings = language_id.Settings()
    dictionaries = language_id.fit_documents(documents[0], settings)
    got = {row.doc_id: row for row in QUERIES["op10_language_id"](spark, FOLDER).collect()}

    def size(text, name, level):
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        one = zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)
        data = text.lower().encode()
        return sum(len(one.compress(data[at : at + 2048])) for at in range(0, len(data), 2048))

    names = sorted(dictionaries)
    for row in documents[1][:120]:
        sizes = {name: size(row.text, name, 6) for name in names}
        first, second = sorted(sizes.values())[:2]
        if 1 - first / second < settings.min_margin:
            sizes = {name: sizes[name] + sum(size(row.text, name, level) for level in (1, 3, 4, 5)) for name in names}
        first, second = sorted(sizes.values())[:2]
        told = got[row.doc_id]
        assert told.lang_pred == min(names, key=lambda name: (sizes[name], name))
        assert told.margin == pytest.approx(1 - first / second) and told.accepted is (told.margin >= settings.min_margin)


def test_numbers_are_no_letters(spark):
    rows = [(0, "½ ²"), (1, "Ⅷ"), (2, "12 ٣ ४"), (3, "_ - ."), (4, "́"), (5, "x"), (6, "ª"), (7, "中"), (8, "１２")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = language_id.language_id(df, {"a": b"abc", "b": b"xyz"}, language_id.Settings()).collect()
    assert {row.doc_id for row in told if row.language.lang_pred != "und"} == {5, 6, 7}


def test_every_language_is_learned(spark):
    """More languages than are sent to the driver, or held by a task, at a time; the last in the alphabet count too."""
    def word(i, k):
        return hashlib.md5(f"{i}:{k}".encode()).hexdigest()[:7]

    rows = [(100 * i + n, " ".join(word(i, (n + k) % 30) for k in range(40)), f"l{i:02d}") for i in range(23) for n in range(6)]
    df = spark.createDataFrame([*rows, (1, "", "none"), (2, "x", None)], "doc_id long, text string, lang string").repartition(3)
    few, all_at_once = (language_id.Settings(docs=4, slice_chars=300, languages=most) for most in (5, 100))
    dictionaries = language_id.fit(df, few)
    assert len(dictionaries) == 23 and dictionaries == language_id.fit(df, all_at_once)
    told = [{row.doc_id: row.language for row in language_id.language_id(df, dictionaries, s).collect()} for s in (few, all_at_once)]
    assert told[0] == told[1]
    assert all(told[0][doc_id].lang_pred == lang for doc_id, _, lang in rows)


def test_odd_texts(spark, odd_texts):
    """Null and empty texts, long ones, repeated rows, clashing names, an empty table."""
    rules = quality_rules.quality_rules(odd_texts, out="kept")
    assert rules.columns == odd_texts.columns
    got = {row.doc_id: row for row in rules.collect()}
    assert rules.count() == odd_texts.count()
    assert (got[0].kept.n_words, got[0].kept.ratio, got[0].kept.kept) == (0, None, False)
    assert got[1].kept == got[0].kept and got[8].kept.n_words == 20_000 and got[8].kept.base_failed
    assert got[4].kept == got[5].kept

    settings = language_id.Settings(docs=3, slice_chars=100)
    dictionaries = language_id.fit(odd_texts, settings)
    assert set(dictionaries) == {"en"}
    for known in (dictionaries, {}, {"a": b"the same words", "b": b"the same words"}):
        told = language_id.language_id(odd_texts, known, settings, out="row")
        assert told.columns == odd_texts.columns
        rows = {row.doc_id: row["row"] for row in told.collect()}
        assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and rows[3].lang_pred == (min(known) if known else "und")
        assert not rows[0].accepted and all(0 <= r.score <= 1 for r in rows.values())

    trees = quality_model.fit_trees(np.zeros((0, len(quality_model.FEATURES))), np.zeros(0), quality_model.Settings())
    scored = quality_model.quality_score(odd_texts, trees, out="kept")
    assert scored.columns == odd_texts.columns and {row.kept for row in scored.collect()} == {0.5}

    empty = odd_texts.limit(0)
    assert quality_rules.quality_rules(empty).count() == 0
    assert language_id.fit(empty, settings) == {}
    assert language_id.language_id(empty, {}, settings).count() == 0
    x, y = quality_model.training_rows(empty, spark.createDataFrame([], "doc_id long, quality int"), quality_model.Settings())
    assert x.shape == (0, len(quality_model.FEATURES)) and len(y) == 0
    assert quality_model.quality_score(empty, trees).count() == 0
