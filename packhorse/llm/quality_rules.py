"""Operator 7: quality rules with compression bands.

A text that repeats itself compresses too well, random characters too badly.
Both are judged by the zstandard ratio of the whole text and of its chunks,
against limits that depend on the length, as short texts compress badly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import by_small_batches, give_back, table

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    dtype=np.uint64,
)

# Lengths in bytes from which a pair of limits holds, with the lowest and the
# highest ratio of compressed to whole size that is kept. Encoded or encrypted
# data lie above, and text that says the same again and again below.
WHOLE_BANDS = (
    (0, 0.0, 9.0),
    (64, 0.45, 1.25),
    (256, 0.38, 0.95),
    (1024, 0.28, 0.74),
    (4096, 0.24, 0.70),
    (16384, 0.16, 0.70),
)
CHUNK_BAND = (0.20, 0.72)
# Scripts of three bytes a character, of which there are thousands, compress less:
# what is added to the highest ratios where characters take `WIDE` bytes on average.
WIDE, WIDER = 2.2, 0.14
# Bytes from which the rest of a text behind its full chunks is judged as one of them.
LEAST_TAIL = 256


@dataclass(frozen=True)
class Bands:
    """Parameters of the compression rule.

    A text is rejected when its whole ratio leaves its band, or when more than
    `chunk_share` of its chunks leave theirs. The rest behind the full chunks
    is a chunk with the band of a text of its length. Of 10,000 documents of the given
    kind each has all of its chunks inside or all outside; the share leaves room for
    a listing or a table in a long text.
    """

    whole: tuple[tuple[int, float, float], ...] = WHOLE_BANDS
    chunk: tuple[float, float] = CHUNK_BAND
    chunk_bytes: int = 4096
    chunk_share: float = 0.25
    wider: float = WIDER
    level: int = 3


RESULT = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [
        T.StructField("ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_bad_chunks", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of five words that occurs twice or more in the text."""
    windows = len(words) - WINDOW + 1
    if windows < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(windows, np.uint64)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) + ids[k : k + windows] * _MIX[k]
        key *= _MIX[0]
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(windows, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : k + windows] |= twice
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(text: str | None, squeeze: zstandard.ZstdCompressor, bands: Bands) -> tuple:
    text = text or ""
    data = text.encode()
    words = data.split()
    n_words = len(words)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    again = repeated_words(words)
    failed = n_words < 10 or 100 * again > 20 * n_words
    wider = bands.wider if len(data) >= WIDE * max(1, len(text)) else 0.0

    def inside(part: bytes, band: tuple[float, float]) -> tuple[float, bool]:
        found = len(squeeze.compress(part)) / len(part)
        return found, band[0] <= found <= band[1] + wider

    def of_length(n: int) -> tuple[float, float]:
        return max(band for band in bands.whole if band[0] <= n)[1:]

    ratio, kept = inside(data, of_length(len(data))) if data else (None, True)
    size = bands.chunk_bytes
    chunks = [data[at : at + size] for at in range(0, len(data) - size + 1, size)]
    bad = sum(not inside(chunk, bands.chunk)[1] for chunk in chunks)
    n_chunks, rest = len(chunks), data[len(chunks) * size :]
    if chunks and len(rest) >= LEAST_TAIL:
        n_chunks += 1
        bad += not inside(rest, of_length(len(rest)))[1]
    kept = kept and bad <= bands.chunk_share * n_chunks
    return (
        n_words, len(text) - spaces, symbols, repeated_lines(data), again,
        ratio, n_chunks, bad, failed, kept and not failed,
    )


def quality_rules(df: DataFrame, text: str = "text", out: str = "quality", bands: Bands | None = None) -> DataFrame:
    """`df` with a struct `out`: the base counts, the ratios and the verdict `kept`.

    Whole texts of any length are read. A null text counts as empty; an empty
    text has no ratio, no words, and fails the base rules. Repeated rows and ties
    are judged alike, an empty table gives an empty one, and a column that is
    already named `out` is replaced. Words are parted by ASCII white space.
    """
    bands = bands or Bands()

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=bands.level)
        for texts in batches:
            rows = [measure(value, squeeze, bands) for value in texts]
            yield pd.DataFrame(rows, columns=RESULT.names)
        give_back()

    return by_small_batches(df).withColumn(out, judge(F.col(text)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*")


QUERIES = {"op7_quality_rules": op7_quality_rules}
ORACLES: dict[str, str] = {}
