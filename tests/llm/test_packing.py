"""Operators 1 and 9: every token in one place, mixtures, and tables that move little."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packhorse.llm import packing, sharding

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(packing.production().tokenizer)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check_pieces(rows, texts, tokenizer, window=4096):
    """Each id of each document in one piece, sequences full and without gaps."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        of_doc[row.doc_id].append(row)
        of_sequence[row.sequence_id].append(row)
    assert set(of_doc) == set(texts)
    for key, pieces in of_doc.items():
        ids, at = ids_of(tokenizer, texts[key]), 0
        for row in sorted(pieces, key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids)) and row.length > 0
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    assert sorted(of_sequence) == list(range(len(of_sequence)))
    for number, pieces in of_sequence.items():
        at = 0
        for row in sorted(pieces, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at == window or (number == len(of_sequence) - 1 and at < window)
    return of_sequence


def test_packing_by_brute_force(spark, documents, tokenizer):
    df, rows = documents
    texts = {row.doc_id: row.text for row in rows}
    pieces = packing.op1_packing(spark, FOLDER).collect()
    sequences = check_pieces(pieces, texts, tokenizer)
    total = Counter()
    for row in pieces:
        total[row.source] += row.length
    whole, sent = sum(total.values()), Counter()
    for number in range(len(sequences) - 1):
        for row in sequences[number]:
            sent[row.source] += row.length
        done = (number + 1) * 4096
        # No queue is ahead of its share, or behind it, by more than its quantum.
        assert all(abs(sent[s] - done * total[s] / whole) <= 256 for s in total)


def test_target_proportions(spark, tokenizer):
    """Two queues of one length at 3 to 1: so they are sent, until the first runs dry."""
    rows = [(i, "word " * 99, "a" if i % 2 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    settings = packing.Settings(packing.production().tokenizer, window=1000, quantum=50)
    pieces = packing.pack(df, settings, shares={"a": 0.75, "b": 0.25}).collect()
    check_pieces(pieces, {i: text for i, text, _ in rows}, tokenizer, 1000)
    by_window = defaultdict(Counter)
    for row in pieces:
        by_window[row.sequence_id][row.source] += row.length
    assert all(abs(by_window[n]["a"] - 750) <= 50 for n in range(26))
    assert by_window[38] == {"b": 1000}


def proportions(spark, tokenizer, counts, windows, **settings):
    """The share of each source in the first windows, for sources of so many texts of a hundred tokens."""
    rows = [(i, "word " * 99, source) for i, source in enumerate(s for s, n in counts.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = packing.pack(df, packing.Settings(packing.production().tokenizer, window=1000, quantum=50), **settings).collect()
    check_pieces(pieces, {i: text for i, text, _ in rows}, tokenizer, 1000)
    sent = Counter()
    for row in pieces:
        sent[row.source] += row.length if row.sequence_id < windows else 0
    return {source: n / 1000 / windows for source, n in sent.items()}


def test_shares_of_named_and_other_sources(spark, tokenizer):
    counts = {"a": 100, "b": 300, "c": 100}
    # What a leaves is shared by the others as their sizes are.
    got = proportions(spark, tokenizer, counts, 10, shares={"a": 0.5, "gone": 0.3})
    assert got == pytest.approx({"a": 0.5, "b": 0.375, "c": 0.125}, abs=0.01)
    got = proportions(spark, tokenizer, counts, 10, shares={"a": 3, "b": 1})
    assert got == pytest.approx({"a": 0.75, "b": 0.25, "c": 0}, abs=0.01)
    got = proportions(spark, tokenizer, counts, 40, shares={"c": 0})
    assert got == pytest.approx({"a": 0.25, "b": 0.75, "c": 0}, abs=0.01)
    got = proportions(spark, tokenizer, {"a": 10, "b": 10}, 1, shares={"a": 0, "b": 0})
    assert got == {"a": 1, "b": 0}
    got = proportions(spark, tokenizer, {"a": 40, "b": 160}, 10, temperature=0.5)
    assert got == pytest.approx({"a": 1 / 3, "b": 2 / 3}, abs=0.01)
    got = proportions(spark, tokenizer, {"a": 40, None: 160}, 6, shares={"a": 0.5})
    assert got == pytest.approx({"a": 0.5, None: 0.5}, abs=0.01)
    for bad in ({"a": -0.1}, {"a": float("nan")}, {"a": float("inf")}):
        with pytest.raises(ValueError, match="shares must be"):
            packing.pack(spark.createDataFrame([], "doc_id long, text string, source string"), packing.production(), shares=bad)


def test_columns_of_the_contract_come_first(spark):
    columns = packing.op1_packing(spark, "/root/testdata/sf0.001").columns
    assert columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_odd_texts_are_packed(odd_texts, tokenizer):
    df = odd_texts.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {row.doc_id: row.text for row in df.collect()}
    settings = packing.Settings(packing.production().tokenizer, window=64, quantum=16)
    check_pieces(packing.pack(df, settings).collect(), texts, tokenizer, 64)
    every = packing.pack(odd_texts, settings).agg(F.sum("length")).first()[0]
    assert every == sum(len(ids_of(tokenizer, row.text)) for row in odd_texts.collect())
    assert packing.pack(odd_texts.limit(0), settings).count() == 0


def test_words_are_the_tokenizers(tokenizer):
    encoder = packing.WordEncoder(packing.production().tokenizer, 50)
    assert encoder.direct
    texts = [
        "It's DON'T we'll I'd ''s 't", "a.b,c!! ... ,, .", "12½3 _x_ ª²µ ÿÀ", "\x1c\x1d a\x85b\xa0c\x0bd\x0ce", "<|endoftext|> x",
        "ΣΑΣ İstanbul é", "日本 語", "", " ", "\x00\x7f\xad", "caf\xe9 CAF\xc9 \xdf\xd7\xf7", "naïve." * 30,
    ]
    got = encoder.encode(texts * 2, 2)
    assert got == [ids_of(tokenizer, text).tobytes() for text in texts] * 2


def maglev(names, size):
    """The same table with a list of preferences each."""
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    wishes = {}
    for name in names:
        first, step = number(f"offset:{name}") % size, number(f"skip:{name}") % (size - 1) + 1
        wishes[name] = [(first + j * step) % size for j in range(size)]
    table, turn = {}, 0
    while len(table) < size:
        name = sorted(names)[turn % len(names)]
        table[next(slot for slot in wishes[name] if slot not in table)] = name
        turn += 1
    return [table[slot] for slot in range(size)]


def test_lookup_table():
    names = [f"n{i}" for i in range(7)]
    lookup = sharding.fill(names, 101)
    assert [lookup.shards[owner] for owner in lookup.owners] == maglev(names, 101)
    assert sharding.fill(names[::-1], 101) == lookup
    assert sharding.prime_from(100) == 101 and sharding.prime_from(1) == 2
    shares = Counter(lookup.owners).values()
    assert max(shares) - min(shares) <= 1
    before, after = sharding.fill(names, 1009), sharding.fill(names[1:], 1009)
    moved = sum(
        before.shards[a] != after.shards[b] for a, b in zip(before.owners, after.owners, strict=True) if before.shards[a] != "n0"
    )
    assert moved < 0.15 * 1009
    for bad in (([], None), (names, 100), (names, 5)):
        with pytest.raises(ValueError, match="shards"):
            sharding.fill(*bad)


def test_placement(spark, odd_texts, tmp_path):
    lookup = sharding.fill(["x", "y", "z"], 31)
    odd_texts = odd_texts.selectExpr("*", "1 AS _slot", "2 AS _shard", "3 AS number", "4 AS name")
    placed = sharding.place(odd_texts.withColumn("shard", F.lit("clash")), lookup)
    rows = placed.collect()
    assert {(r._slot, r._shard, r.number, r.name) for r in rows} == {(1, 2, 3, 4)}
    assert len(rows) == odd_texts.count() and placed.columns == [*odd_texts.columns, "slot", "shard"]
    for row in rows:
        key = "" if row.doc_id is None else str(row.doc_id)
        assert row.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 31
        assert row.shard == lookup.shards[lookup.owners[row.slot]]
    assert sharding.place(odd_texts.limit(0), lookup).count() == 0
    sharding.write_shards(odd_texts, lookup, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    sharding.write_shards(odd_texts.limit(0), lookup, str(tmp_path / "none"))
    assert spark.read.schema(odd_texts.schema).parquet(str(tmp_path / "none")).count() == 0


def test_documents_are_written_by_shard(spark):
    """The query moves whole documents: its result is read from one folder per shard."""
    files = sharding.op9_sharding(spark, FOLDER).inputFiles()
    folders = {name.rpartition("/")[0].rpartition("shard=")[2] for name in files}
    assert folders == set(sharding.PRODUCTION_SHARDS)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    written = spark.read.parquet(files[0].partition("/shard=")[0])
    assert sorted(written.select(*given.columns).collect()) == sorted(given.collect())
