"""Operator 12: duplicate passages by relative Lempel-Ziv parsing against an index of the corpus.

Documents are parsed into phrases that depend on content alone: of the starts
of eight words within a window of `WINDOW` words, the one with the least hash is
its anchor, and a phrase is a run of windows with one anchor. Equal windows have
equal anchors, wherever they stand. The corpus is its own reference; the index
of its phrases lies in blocks by anchor, the partitions of a shuffle, so the one
block that may hold a match stands for every block.

A document is factored from left to right: phrases that the index holds
elsewhere, too, are strung together to factors. Where a phrase is not met whole
but its anchor is, a factor ends within it: there the windows are looked up one
by one. Factors are at least a window long; the words that they cover are
duplicate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import by_small_batches, give_back, slices, stored, table
from packhorse.session import delete_scratch, scratch_path

# Words of a window (the contract's), and of an anchor.
WINDOW = 35
ANCHOR = 8
# Bytes that are hashed, and windows that are parsed, at a time.
BYTES = 1 << 20
WINDOWS = 1 << 18
# A phrase in one number: first window, number of windows less one, and what is known of it.
LENGTH_BITS = 6
KNOWN_BITS = 2
REPEATED, OFFERED, OPEN = 1, 2, 3

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _numbers(label: str, n: int) -> np.ndarray:
    """`n` odd 64-bit numbers that look random, the same everywhere."""
    return np.frombuffer(hashlib.shake_256(label.encode()).digest(8 * n), "<u8") | np.uint64(1)


_BYTE = _numbers("bytes", 256)
_STEP, _OTHER_STEP, _IN_WORD, _FOLD, _MIX, _MIX_AGAIN = _numbers("steps", 6)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX_AGAIN
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashed(data: np.ndarray) -> np.ndarray:
    """The 64-bit hashes of the words of a piece of text that ends with a word."""
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    power = _powers(_IN_WORD, int(lengths.max()))
    return _mixed(np.add.reduceat(_BYTE[data[inside]] * power[place], first) + lengths.astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """The hashes of the words of a text, read in pieces that end where a word does."""
    data, parts, at = np.frombuffer(text, np.uint8), [], 0
    while at < len(data):
        end = at + BYTES
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_hashed(data[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class Sums:
    """Hashes of runs of words, from sums of all words before a place."""

    def __init__(self, words: np.ndarray, step: int):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(step, len(words)))])
        self.back = _powers(pow(int(step), -1, 1 << 64), len(words))

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        total = (self.sums[start + length] - self.sums[start]) * self.back[start]
        return _mixed(total + np.asarray(length).astype(np.uint64))


def phrases(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor and phrase hashes, first windows and numbers of windows of a text's phrases."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        nothing = np.zeros(0, np.uint64)
        return nothing, nothing, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = words[: len(words) - ANCHOR + 1].copy()
    for k in range(1, ANCHOR):
        key = _mixed(key * _FOLD + words[k : k + len(key)])
    wide = np.lib.stride_tricks.sliding_window_view(key, WINDOW - ANCHOR + 1)
    sums, found = Sums(words, _STEP), []
    for at in range(0, n, WINDOWS):
        # A phrase that is cut here has another hash; its windows are looked up one by one.
        anchor = np.arange(at, min(at + WINDOWS, n)) + wide[at : at + WINDOWS].argmin(axis=1)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        count = np.diff(np.append(first, len(anchor)))
        found.append((key[anchor[first]], sums.of(first + at, count + WINDOW - 1), first + at, count))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _packed(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (first << LENGTH_BITS | (count - 1)) << KNOWN_BITS


def _unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = codes >> KNOWN_BITS
    return place >> LENGTH_BITS, (place & (1 << LENGTH_BITS) - 1) + 1, codes & (1 << KNOWN_BITS) - 1


def _longs(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array(a.astype(np.uint64).view(np.int64)) for a in arrays]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            anchor, phrase, first, count = phrases(word_hashes(text or b""))
            found.append((anchor, phrase, np.full(len(first), name), _packed(first, count)))
        if found:
            columns = [np.concatenate(part) for part in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(_longs(*columns), names=["anchor", "phrase", "id", "at"])
    give_back()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of phrases that are not met whole, and of those that offer theirs (with a null id), each once a task."""
    offered: set[tuple[int, int]] = set()
    for batch in slices(batches):
        found = []
        for name, text, codes in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            first, count, known = _unpacked(np.array(codes, np.int64))
            words = word_hashes(text)
            sums, other = Sums(words, _STEP), Sums(words, _OTHER_STEP)
            if OFFERED in known:
                start, length = first[known == OFFERED], count[known == OFFERED] + WINDOW - 1
                fresh = []
                for k, pair in enumerate(zip(sums.of(start, length).tolist(), other.of(start, length).tolist(), strict=True)):
                    if pair not in offered:
                        fresh.append(k)
                        if len(offered) < WINDOWS:
                            offered.add(pair)
                start, length = start[fresh], length[fresh] - WINDOW + 1
                all_of = np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
                found.append((sums.of(all_of, WINDOW), other.of(all_of, WINDOW), None, all_of))
            start, length = first[known == OPEN], count[known == OPEN]
            all_of = np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
            found.append((sums.of(all_of, WINDOW), other.of(all_of, WINDOW), name, all_of))
        if found:
            hashes = [np.concatenate([part[k] for part in found]) for k in (0, 1, 3)]
            owner = pa.concat_arrays([
                pa.nulls(len(at), pa.int64()) if name is None else pa.array(np.full(len(at), name)) for _, _, name, at in found
            ])
            one, two, at = _longs(*hashes)
            yield pa.RecordBatch.from_arrays([one, two, owner, at], names=["window", "check", "id", "start"])
    offered.clear()
    give_back()


def _covered(n: int, codes: list[int] | None, starts: list[int] | None) -> np.ndarray:
    """Which of n words are covered by repeated phrases (`codes`) or windows (`starts`)."""
    first, count, known = _unpacked(np.array(codes or [], np.int64))
    first, count = first[known != OPEN], count[known != OPEN] + WINDOW - 1
    more = np.array(starts or [], np.int64)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.concatenate([first, more]), 1)
    np.subtract.at(change, np.concatenate([first + count, more + WINDOW]), 1)
    return np.cumsum(change[:-1]) > 0


_OUT = pa.struct([
    ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("factors", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.string()),
])
_OUT_DDL = "struct<n_words long, n_removed long, factors array<struct<start long, length long>>, kept string>"


def _told(text: bytes | None, codes: list[int] | None, starts: list[int] | None) -> dict:
    words = (text or b"").split()
    n, factors = len(words), []
    if codes:
        covered = _covered(n, codes, starts)
        edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        factors = [{"start": a, "length": b - a} for a, b in edge.reshape(-1, 2).tolist()]
        words = [word for word, gone in zip(words, covered.tolist(), strict=True) if not gone]
    return {"n_words": n, "n_removed": n - len(words), "factors": factors, "kept": b" ".join(words).decode()}


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns but for the last three (text, codes, starts), and what became of the text."""
    for batch in slices(batches):
        *others, text, codes, starts = batch.columns
        told = [_told(*row) for row in zip(text.to_pylist(), codes.to_pylist(), starts.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(told, _OUT)], names=[*batch.schema.names[:-3], batch.schema.names[-1]]
        )
    give_back()


def _repeats(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per text (id, body): the phrases that are repeated or open, and the windows of the open ones that are repeated."""
    spark = texts.sparkSession

    def kept(df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    parsed, parsed_at = kept(texts.mapInArrow(_parsed, "anchor long, phrase long, id long, at long"), "phrases")
    # Summed up in the map tasks first; a frequent anchor's rows are split by the join at run time.
    index = parsed.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("phrase").alias("low"), F.max("phrase").alias("high")
    ).filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    met, met_at = kept(parsed.join(index, "anchor"), "met")
    delete_scratch(spark, parsed_at)
    mixed = met.filter("mixed")
    twice = mixed.groupBy("anchor", "phrase").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    twice = twice.withColumn("whole", F.lit(True))
    known = mixed.join(twice, ["anchor", "phrase"], "left").select(
        "id", F.when(F.col("whole"), F.col("at") + OFFERED).otherwise(F.col("at") + OPEN).alias("code")
    ).unionByName(met.filter("NOT mixed").select("id", (F.col("at") + REPEATED).alias("code")))
    # Copies of a text have one id, so their phrases are listed once.
    codes = stored(known.groupBy("id").agg(F.collect_set("code").alias("codes")), "codes")
    delete_scratch(spark, met_at)

    is_open = F.exists("codes", lambda code: code.bitwiseAND(F.lit(3)) != REPEATED)
    asked = codes.filter(is_open).select(
        "id", F.filter("codes", lambda code: code.bitwiseAND(F.lit(3)) != REPEATED).alias("codes")
    )
    bodies = texts.join(asked, "id").select("id", "body", "codes")
    windows = stored(bodies.mapInArrow(_windows, "window long, check long, id long, start long"), "windows")
    again = windows.groupBy("window", "check").agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("owned")
    ).filter("n > 1 AND owned > 0").select("window", "check")
    starts = windows.filter("id IS NOT NULL").join(again, ["window", "check"], "left_semi")
    return codes, starts.groupBy("id").agg(F.collect_set("start").alias("starts"))


def without_repeats(df: DataFrame, text: str = "text", out: str = "repeats") -> DataFrame:
    """`df` with a struct `out`: n_words, n_removed, the `factors` (start, length in words) and the text `kept`.

    A word goes if a window of `WINDOW` consecutive words that covers it starts
    anywhere else, too, in the same text or another, copies among them. Words are
    what ASCII white space parts; those that stay are joined by one space. A null
    text has no words and an empty text is kept; texts of fewer words than a
    window stay whole. Repeated rows are copies of each other; ties do not arise.
    Columns of any name are passed on, but for one named `out`, which is
    replaced; an empty table gives an empty one. Long texts are parsed in pieces.
    Texts are told apart by a 64-bit hash, phrases and windows by 128 bits.
    """
    names = [f"_{k}_{out}" for k in ("text", "codes", "starts", "id")]
    while set(names) & set(df.columns):
        names = [f"_{name}" for name in names]
    body, codes_of, starts_of, name = names
    texts = by_small_batches(df).select(
        F.xxhash64(F.col(f"`{text}`")).alias("id"), F.col(f"`{text}`").cast("binary").alias("body")
    )
    codes, starts = _repeats(texts)
    marks = codes.join(starts, "id", "left").select(
        F.col("id").alias(name), F.col("codes").alias(codes_of), F.col("starts").alias(starts_of)
    )
    others = [c for c in df.columns if c != out]
    rows = df.select(
        *[F.col(f"`{c}`") for c in others], F.xxhash64(F.col(f"`{text}`")).alias(name), F.col(f"`{text}`").cast("binary").alias(body)
    )
    rows = rows.join(marks, name, "left").select(*[F.col(f"`{c}`") for c in others], body, codes_of, starts_of)
    schema = df.select(*[F.col(f"`{c}`") for c in others]).schema.add(starts_of, T.DataType.fromDDL(_OUT_DDL))
    return rows.mapInArrow(_finished, schema).withColumnRenamed(starts_of, out)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = without_repeats(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2(F.col("repeats.kept").cast("binary"), 256).alias("kept_sha256")
    )


_ORACLE = rf"""
    WITH words AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    windows AS (
        SELECT r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
        FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words)),
    twice AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM twice),
    one AS (SELECT r, doc_id, len(w) AS n, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS word,
        unnest(CASE WHEN len(w) = 0 THEN [0] ELSE range(1, len(w) + 1) END) AS p FROM words)
    SELECT doc_id, n::BIGINT AS n_words, count(gone.p)::BIGINT AS n_removed,
        sha256(coalesce(string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY one.p), '')) AS kept_sha256
    FROM one LEFT JOIN gone ON gone.r = one.r AND gone.p = one.p GROUP BY one.r, doc_id, n
"""

QUERIES = {"op12_substring_dedup": op12_substring_dedup}
ORACLES = {"op12_substring_dedup": _ORACLE}
