"""Operator 8 against the library that the model was made with, and back again."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F

from packhorse.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.production()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_given_documents(spark, documents, model, library):
    """Equal to the library on whole texts, with most segments joined and with none broadcast, and back."""
    df, rows = documents
    want = {row.doc_id: library.encode(row.text) for row in rows}
    encoded = pieces.encode(df.select("doc_id", "text"), model, frequent=2000)
    got = encoded.collect()
    assert {row.doc_id: list(row.ids) for row in got} == want and len(got) == len(rows)
    decoded = pieces.decode(encoded.drop("text"), model).collect()
    assert {row.doc_id: row.text for row in decoded} == {row.doc_id: row.text for row in rows}


def test_odd_texts(spark, odd_texts, model, library):
    more = [(50, "  two  spaces   three " + " " * 70 + "x"), (51, "a▁b"), (52, "ab" * 200), (53, "日本語テキスト" * 30), (54, "\U0001f600́")]
    df = odd_texts.select("doc_id", "text", "row").unionByName(
        spark.createDataFrame(more, "doc_id long, text string").withColumn("row", F.lit(""))
    )
    for frequent in (0, 100_000):
        encoded = pieces.encode(df, model, out="row", frequent=frequent)
        assert encoded.columns == df.columns
        rows = encoded.collect()
        assert len(rows) == df.count()
        for row in rows:
            assert list(row["row"]) == library.encode(row.text or "")
    back = pieces.decode(encoded, model, "row", "again").collect()
    assert all(row.again == (row.text or "").replace("▁", " ") for row in back)
    assert pieces.encode(df.limit(0), model).count() == 0
    assert pieces.decode(encoded.limit(0), model, "row").count() == 0


def test_buckets_do_not_show(spark, model, library, monkeypatch):
    """Small buckets and parts, one row in a third of the table, columns with names of the operator's own, the text left out."""
    monkeypatch.setattr(pieces, "BUCKET_CHARS", 300)
    monkeypatch.setattr(pieces, "PART_CHARS", 200)
    monkeypatch.setattr(pieces, "LONGEST", 12)
    rows = [(k, f"text number {k} has a word{k} of its own, unforgettableandlong{k}", 1, 2) for k in range(60)]
    rows += [(99, "the same row again and again", 1, 2)] * 30 + [(100, None, 1, 2), (101, "", 1, 2), (None, "x", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int, small int").repartition(6)
    for frequent in (0, 20):
        got = pieces.encode(df, model, frequent=frequent)
        assert got.columns == [*df.columns, "ids"]
        told = sorted(((r.doc_id, r.text, r.bucket, r.small, list(r.ids)) for r in got.collect()), key=str)
        assert told == sorted(((*row, library.encode(row[1] or "")) for row in rows), key=str)
    bare = pieces.encode(df, model, keep_text=False)
    assert bare.columns == ["doc_id", "bucket", "small", "ids"] and bare.count() == len(rows)


def test_texts_and_segments_are_shuffled_once(spark, model):
    """Of the exchanges of texts and of segments both readers read one."""
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    encoded = pieces.encode(df, model, frequent=0)
    encoded.collect()
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("ReusedExchange") == 2


def table_of(scores):
    rows = tuple((text, i, score) for i, (text, score) in enumerate(scores.items()))
    return pieces.Pieces(rows, tuple(range(1000, 1256)), max(map(len, scores)), pieces._segment(rows))


def by_merges(text, scores):
    parts = list(text)
    while True:
        ways = [(-scores[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in scores]
        if not ways:
            return parts
        _, i = min(ways)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_folds_by_brute_force(spark):
    """Merges, in one pass or pair by pair or from a heap, and the best path, on all short words."""
    scores = {"a": 0.0, "b": 0.0, "c": 0.0, "ab": -3.0, "bc": -1.0, "abc": -2.0, "ca": -2.5, "cab": -1.5, "aa": -4.0, "aaa": -0.5, "bb": -1.0}
    model = table_of(scores)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abcd", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "segment string")
    size = F.length("segment")
    rows = pieces.lattice(df, model).select(
        "segment", pieces.merged(F.col("edges"), size).alias("cuts"),
        pieces.merged_in_order(F.col("edges"), size).alias("pass"),
        pieces.viterbi(F.col("edges"), size, model.longest, -50.0).alias("path"),
    ).collect()
    assert len(rows) == len(words)
    odd = 0
    for row in rows:
        word, want = row.segment, by_merges(row.segment, scores)
        parts = [word[a:b] for a, b in itertools.pairwise(row.cuts)]
        assert parts == want == pieces.merge_long(word, scores)
        bits = [at for at in range(len(word) + 1) if row["pass"].cuts >> at & 1]
        odd += row["pass"].odd
        assert row["pass"].odd or [word[a:b] for a, b in itertools.pairwise(bits)] == want
        sums = {}
        for marks in itertools.product([0, 1], repeat=len(word) - 1):
            cuts = [0, *(i + 1 for i, m in enumerate(marks) if m), len(word)]
            spans = [word[a:b] for a, b in itertools.pairwise(cuts)]
            if all(s in scores or len(s) == 1 for s in spans):
                sums[tuple(cuts)] = sum(scores.get(s, -50.0) for s in spans)
        assert sums[tuple(row.path)] == max(sums.values())
    assert odd > 0
    encoded = {row.segment: list(row.ids) for row in pieces.encode_segments(df, model, longest=4).collect()}
    names = list(scores)
    for word in words:
        ids = [i for part in by_merges(word, scores) for i in ([names.index(part)] if part in scores else [1000 + x for x in part.encode()])]
        assert encoded[word] == ids


def test_cutting_and_merging_side_by_side(model, library):
    """Segments as the pattern cuts them, and merges of a batch of segments as those of a heap, in two-byte and four-byte ids."""
    texts = [" lead", "two  spaces, x9y.", "end. ", "line.\nNext ▁ mark", "été·日本語 ٣٤ áb Ⅻ", "plain words only", "", None, "   ", "\U0001f600ok", "¡x!!"]
    for often in ([], ["▁words", "▁plain", "."]):
        cutter = pieces.Cutter(model, pa.array(often, pa.string()))
        units, numbers, counts = cutter.units_of([text and text.encode() for text in texts])
        parts, inside, segments = cutter.cut(units)
        ends, known = np.cumsum(parts), segments.to_pylist()
        of_unit = [[known[k] for k in inside[end - n : end]] for end, n in zip(ends, parts, strict=True)]
        upto = np.cumsum(counts)
        for text, end, n in zip(texts, upto, counts, strict=True):
            got = [segment for number in numbers[end - n : end] for segment in of_unit[number]]
            marked = "▁" + (text or "").replace(" ", "▁")
            assert got == (regex.findall(model.segment, marked) if text else [])
        assert [known[i] for i in cutter.rare(segments)] == sorted(set(known) - set(often))
    scores, rng = model.scores(), random.Random(3)
    words = ["▁" + "".join(rng.choice("eeettaaoinshrdlu日é€") for _ in range(rng.randint(0, 58))) for _ in range(300)] + ["a" * 60, "b" * 70]
    for plus in (0, 100_000):
        wide = pieces.Pieces(tuple((t, i + plus, s) for t, i, s in model.rows), model.bytes, model.longest, model.segment)
        found = [[((a * pieces.SPAN + n), {"score": scores[w[a : a + n]], "id": wide.by_text[1][w[a : a + n]]})
                  for a in range(len(w)) for n in range(1, 17) if a + n <= len(w) <= 60 and w[a : a + n] in scores] for w in words]
        edges = pa.array([rng.sample(one, len(one)) for one in found], pa.map_(pa.int32(), pa.struct([("score", pa.float64()), ("id", pa.int32())])))
        cuts, odd = pieces._in_order(edges, np.minimum([len(w) for w in words], 60).astype(np.int32))
        codes = pieces._packed(pa.array(words), edges, cuts, wide, 60).to_pylist()
        assert wide.width == (4 if plus else 2) and not odd.all()
        for word, code, is_odd in zip(words, codes, odd, strict=True):
            assert is_odd or np.frombuffer(code, wide.code).tolist() == pieces.long_ids(word, wide, *wide.by_text)
        # Parts of batches are told like whole ones.
        again, _ = pieces._in_order(edges.slice(7, 90), np.array([len(w) for w in words[7:97]], np.int32))
        assert again.tolist() == cuts[7:97].tolist()


def test_four_byte_ids(spark, model):
    """Encoding, with frequent segments and without, where ids do not fit in two bytes."""
    wide = pieces.Pieces(tuple((t, i + 100_000, s) for t, i, s in model.rows), model.bytes, model.longest, model.segment)
    df = spark.createDataFrame([(k, f"some words, number {k}… and 日本 \U0001f600 {'x' * 70}") for k in range(5)], "doc_id long, text string")
    want = {k: [i if i in model.bytes else i + 100_000 for i in ids] for k, ids in pieces.encode(df, model).select("doc_id", "ids").collect()}
    for frequent in (0, 20):
        assert {row.doc_id: list(row.ids) for row in pieces.encode(df, wide, frequent=frequent).collect()} == want


def test_ids_go_back_in_bundles(spark, model, monkeypatch):
    """A task sends one row for each bucket, not one for each segment; of more rows than it holds at a time, some."""
    df = spark.createDataFrame([(k, f"word{k} and other{k} things{k}") for k in range(200)], "doc_id long, text string")

    def rows():
        return {row.doc_id: list(row.ids) for row in pieces.encode(df, model, frequent=0).collect()}

    whole = rows()
    monkeypatch.setattr(pieces, "BUNDLE_ROWS", 3)
    assert rows() == whole and len(whole) == 200
    made = [
        pa.RecordBatch.from_pydict({"bucket": [5, 2, 5], "place": [4, 0, 70_000], "code": [b"\x01\x00", b"", b"\x02\x00\x03\x00"]}),
        pa.RecordBatch.from_pydict({"bucket": [5], "place": [1], "code": [b"\x09\x00"]}),
    ]
    monkeypatch.setattr(pieces, "BUNDLE_ROWS", 500_000)
    (bundles,) = pieces._bundled("<u2")(iter(made))
    assert bundles.column("bucket").to_pylist() == [2, 5]
    places, lengths, ids = pieces._unbundled(bundles.column("found").to_pylist(), "<u2")
    assert [x.tolist() for x in (places, lengths, ids)] == [[0, 1, 4, 70_000], [0, 1, 1, 2], [9, 1, 2, 3]]
    assert [len(x) for x in pieces._unbundled([], "<u2")] == [0, 0, 0]
