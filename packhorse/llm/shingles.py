"""Sets of word shingles, as sorted 64-bit hashes, and how common shingles are in a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhorse.llm.common import give_back, stored

WORDS = 5
# A common count is kept for all shingles whose hashes share these leading bits.
BUCKET_BITS = 22
CHUNKS = 64
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of `text`.

    Words are parted by ASCII white space, A-Z lower-cased. Fewer than five
    words are one shingle; no words, or a null text, are the empty set.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    key = np.zeros(n, np.uint64)
    for k in range(WORDS):
        key = _stir(key + one[k : k + n] * _ODD[k])
    return np.unique(key)


def set_id(items: np.ndarray) -> int:
    """A 64-bit name for a set, as a signed number; 0 for the empty set."""
    return int(np.array([xxhash.xxh3_64_intdigest(items.tobytes())], np.uint64).view(np.int64)[0]) if len(items) else 0


def bucket_of(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def scan(docs: DataFrame, label: str) -> DataFrame:
    """One stored pass over `key` and `text`, for `described` and `bucket_counts`.

    Rows with a null `counts` describe documents; the others hold, per task, one
    of `CHUNKS` parts of the number of its documents that hold a shingle of each bucket.
    """
    key_type = docs.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        seen = False
        for batch in batches:
            names, sizes = [], []
            for text in batch["text"]:
                items = shingle_set(text)
                names.append(set_id(items))
                sizes.append(len(items))
                counts[bucket_of(items)] += np.uint32(1)
            seen = seen or len(batch) > 0
            yield pd.DataFrame(
                {"key": batch["key"], "text_hash": batch["text_hash"], "set": names, "n": sizes, "chunk": -1, "counts": None}
            )
        if seen:
            squeeze = zstandard.ZstdCompressor(level=1)
            parts = [squeeze.compress(part.tobytes()) for part in np.split(counts, CHUNKS)]
            empty = pd.array([pd.NA] * CHUNKS, dtype="Int64")
            yield pd.DataFrame(
                {"key": None, "text_hash": empty, "set": empty, "n": empty, "chunk": range(CHUNKS), "counts": parts}
            )
        del counts
        give_back()

    schema = f"key {key_type}, text_hash long, set long, n long, chunk int, counts binary"
    return stored(docs.mapInPandas(work, schema), label)


def described(scanned: DataFrame) -> DataFrame:
    return scanned.filter("counts IS NULL").drop("chunk", "counts")


def bucket_counts(scanned: DataFrame) -> np.ndarray:
    """The number of documents per bucket, 16 MB whatever the size of the corpus.

    Summed in two steps, so that a chunk of all tasks does not meet in one.
    """

    def add(group: pd.DataFrame) -> pd.DataFrame:
        expand = zstandard.ZstdDecompressor()
        total = sum(np.frombuffer(expand.decompress(part), np.uint32).astype(np.uint64) for part in group["counts"])
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "counts": [zstandard.compress(total.tobytes(), 1)]})

    parts = scanned.filter("counts IS NOT NULL").select("chunk", "counts")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(32)))
    once = salted.groupBy("chunk", "salt").applyInPandas(add, "chunk int, counts binary")
    rows = once.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect()
    expand = zstandard.ZstdDecompressor()
    whole = {row["chunk"]: np.frombuffer(expand.decompress(row["counts"]), np.uint32) for row in rows}
    if not whole:
        return np.zeros(1 << BUCKET_BITS, np.uint32)
    return np.concatenate([whole[k] for k in range(CHUNKS)])
