"""Operator 1: mixture-controlled packing by deficit round-robin over source queues.

The documents of a source form a queue of tokens. Queues send in turns of one
quantum; whose turn it is follows from the deficits, that is from how far each
queue is behind its share of all that was sent. A queue's k-th quantum is due
at (k + 1/2) / share, so the whole schedule is the order of these times. What
it sends, laid end to end, is cut into windows of a fixed length: deficits
pass from window to window, and from partition to partition, as running sums.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import bounded_broadcast, by_small_batches, give_back, running_start, stored, table


@dataclass(frozen=True)
class Settings:
    """Every window but the last holds `window` tokens.

    `quantum` is what a queue sends in its turn. `tokenizer` is a file of the
    tokenizers library, `end` the id that closes each document. `cache` bounds
    the words whose ids a worker remembers.
    """

    tokenizer: str
    window: int = 4096
    quantum: int = 256
    end: int = 2
    cache: int = 400_000


PIECE = ("start", "length", "ids_crc32", "sequence_id", "offset")
TOKENS = T.StructType([T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
# Lower-case letters, numbers and white space of Latin-1, and the words a tokenizer of
# contractions, letters, single numbers and other characters cuts a text into.
_LETTERS, _NUMBERS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
_CUT = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
# Control characters that are white space for Python alone.
_ODD = re.compile("[\x1c-\x1f]")
_PROBE = "Abc the 'tis it's we'll stra\xdfe \xe9t\xe9,  x.! 20\xbd \xa7_a-b\t#1\xa0\xc9lan \xaa\xd7 don't... \x1c q\x85z"


class WordEncoder:
    """Ids of texts, word by word, for a tokenizer that drops white space.

    Its words do not depend on each other, so the ids of frequent ones are
    remembered. Texts in Latin-1, where composition changes nothing and case
    leaves every letter a letter, are cut into the tokenizer's own words here,
    and these go to its merges directly. Other texts, and all if a probe shows
    that the tokenizer cuts in another way, take the long way.
    """

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        # One thread a task; Spark runs a task on each core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.codes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.most = most
        self.known: dict[str, bytes] = {}
        # Bytes as the letters that a byte-level vocabulary writes them with.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [byte for byte in range(256) if byte not in plain]
        self.letters = {byte: chr(256 + i) for i, byte in enumerate(rest)}
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        self.direct = b"".join(map(self._merged, _CUT.findall(_PROBE.lower()))) == np.array(whole, "<u4").tobytes()

    def _merged(self, word: str) -> bytes:
        word = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.codes[token.id] for token in self.merge(word)])

    def _plain(self, texts: list[str], end: bytes) -> list[bytes]:
        ids = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() + end for one in ids]

    def _word(self, word: str) -> bytes:
        """Ids of what stands between white space; its parts are remembered, and itself while there is much room."""
        known, parts = self.known, _CUT.findall(word)
        ids = []
        for part in parts:
            one = known.get(part)
            if one is None:
                one = self._merged(part)
                if len(known) < self.most:
                    known[part] = one
            ids.append(one)
        whole = b"".join(ids)
        if len(parts) > 1 and 4 * len(known) < self.most:
            known[word] = whole
        return whole

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        known, close, out = self.known, np.array([end], "<u4").tobytes(), []
        for text in texts:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                out += self._plain([text], close)
                continue
            if not self.direct:
                out += self._plain([text], close)
                continue
            words = _CUT.findall(text.lower()) if _ODD.search(text) else text.lower().split()
            ids = list(map(known.get, words))
            ids.append(None)
            at = ids.index(None)
            while at < len(words):
                ids[at] = self._word(words[at])
                at = ids.index(None, at + 1)
            ids[at] = close
            out.append(b"".join(ids))
        return out


def tokenised(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """`df` with the struct `_tokens`: the number of ids, and the ids, compressed."""

    @F.pandas_udf(TOKENS)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(settings.tokenizer, settings.cache)
        squeeze = zstandard.ZstdCompressor(level=1)
        for texts in batches:
            ids = encoder.encode([value or "" for value in texts], settings.end)
            small = [squeeze.compress(_narrow(one)) for one in ids]
            yield pd.DataFrame({"n": [len(one) // 4 for one in ids], "ids": small})
        del encoder
        give_back()

    return df.withColumn("_tokens", encode(F.col(text)))


def _narrow(ids: bytes) -> bytes:
    """The low halves of all ids, then the high halves, which are mostly zero."""
    return np.frombuffer(ids, "<u2").reshape(-1, 2).T.tobytes()


def _wide(halves: bytes) -> bytes:
    return np.frombuffer(halves, "<u2").reshape(2, -1).T.tobytes()


def _pieces(window: int):
    """A function for `mapInArrow` that lists the pieces of each document with the crc32 of their ids.

    A document comes with the parts that its queue sent, in its own order.
    Parts that follow each other in a sequence are one piece.
    """

    def of_document(data: bytes, starts: np.ndarray, lengths: np.ndarray, sent: np.ndarray) -> np.ndarray:
        new = np.flatnonzero(np.r_[True, sent[1:] != sent[:-1] + lengths[:-1]])
        starts, sent = starts[new], sent[new]
        lengths = np.add.reduceat(lengths, new)
        rows = []
        for start, length, place in zip(starts.tolist(), lengths.tolist(), sent.tolist(), strict=True):
            while length:
                sequence, offset = divmod(place, window)
                size = min(length, window - offset)
                rows.append((start, size, zlib.crc32(data[4 * start : 4 * (start + size)]), sequence, offset))
                start, length, place = start + size, length - size, place + size
        return np.array(rows, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            lists = [batch.column(name) for name in ("starts", "lengths", "sent")]
            bounds = np.asarray(lists[0].offsets)
            starts, lengths, sent = (np.asarray(one.values) for one in lists)
            rows = [
                of_document(_wide(expand.decompress(ids.as_py())), starts[a:b], lengths[a:b], sent[a:b])
                for ids, a, b in zip(batch.column("ids"), bounds[:-1], bounds[1:], strict=True)
            ]
            if rows:
                taken = pa.array(np.repeat(np.arange(len(rows)), [len(one) for one in rows]))
                columns = [batch.column(name).take(taken) for name in ("key", "queue", "n")]
                columns += [pa.array(one) for one in np.concatenate(rows).T]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "queue", "n", *PIECE])
        give_back()

    return work


def pack(
    df: DataFrame, settings: Settings, text: str = "text", key: str = "doc_id", source: str = "source",
    shares: dict[str, float] | None = None, temperature: float = 1.0,
) -> DataFrame:
    """One row per piece of a document: `key`, its place in the document and in a sequence, and `source`.

    `shares` are the target proportions of tokens by source, as parts of the whole.
    Sources that are not named share what the named ones leave, by their numbers of
    tokens to the power of `temperature`: with 1 all queues of a table without named
    sources end together, below 1 small sources are sent earlier. Named shares that
    make more than the whole are scaled down. A source whose share is 0 is sent when
    all others have run dry, several of them one after the other, and a queue that has run dry leaves its share to the
    others. No token is dropped or repeated.

    Null and empty texts are the closing id alone; long texts are cut freely. A null
    source is a queue like any other, which can not be named; repeated rows and
    keys are packed each. An empty table gives no pieces. Other columns of `df` are
    left aside, whatever their names.
    """
    named = _checked(shares)
    rows = by_small_batches(df).select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("queue"),
        F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"),
    )
    tokens = stored(tokenised(rows, "text", settings).select("row", "key", "queue", "_tokens.*"), "tokens")
    lengths = running_start(tokens.select("queue", "key", "row", "n"), ["queue", "key", "row"], "n", "at", "queues")
    totals = stored(lengths.groupBy("queue").agg(F.sum("n").alias("total"), F.min("at").alias("first")), "queue-totals")
    of_source = F.create_map(*(F.lit(x) for pair in named.items() for x in pair)) if named else F.create_map().cast("map<string, double>")
    weight = F.pow(F.col("total").cast("double"), F.lit(temperature))
    # The sources that are there; one row of sums.
    told = totals.withColumn("named", F.try_element_at(of_source, F.col("queue"))).withColumn("weight", weight)
    given, others = told.agg(F.sum("named"), F.sum(F.when(F.col("named").isNull(), F.col("weight")))).first()
    whole = max(1.0, given or 0.0) if others else given or 1.0
    share = F.coalesce(F.col("named"), F.lit(max(0.0, 1.0 - (given or 0.0)) / (others or 1.0)) * F.col("weight")) / F.lit(whole)
    totals = told
    totals = bounded_broadcast(totals.select(F.col("queue").alias("q"), "total", "first", share.alias("share")))
    size = settings.quantum
    placed = stored(
        lengths.join(totals, F.col("queue").eqNullSafe(F.col("q")))
        .select("row", "queue", "n", "total", "share", (F.col("at") - F.col("first")).alias("at")),
        "placed",
    )
    # A quantum is listed by the document that holds its first token.
    first = F.ceil(F.col("at") / F.lit(size))
    last = F.floor((F.col("at") + F.col("n") - 1) / F.lit(size))
    quanta = (
        placed.filter(first <= last).select("queue", "total", "share", F.explode(F.sequence(first, last)).alias("k"))
        .select(
            "queue", "k",
            # Never due before what has a share.
            F.when(F.col("share") > 0, (F.col("k") + F.lit(0.5)) / F.col("share")).otherwise(F.lit(math.inf)).alias("due"),
            F.least(F.lit(size), F.col("total") - F.col("k") * size).cast("long").alias("size"),
        )
    )
    turns = running_start(quanta, ["due", "queue", "k"], "size", "sent", "turns")
    spread = placed.select(
        "row", "queue", "n", "at", F.explode(F.sequence(F.floor(F.col("at") / F.lit(size)), last)).alias("k")
    )
    turns = turns.select(F.col("queue").alias("q"), F.col("k").alias("turn"), "size", "sent")
    begin = F.greatest(F.col("at"), F.col("k") * size)
    stop = F.least(F.col("at") + F.col("n"), F.col("k") * size + F.col("size"))
    parts = spread.join(turns, F.col("queue").eqNullSafe(F.col("q")) & (F.col("k") == F.col("turn"))).select(
        "row", (begin - F.col("at")).alias("start"), (stop - begin).alias("length"),
        (F.col("sent") + begin - F.col("k") * size).alias("sent"),
    )
    by_row = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sent"))).alias("parts"))
    met = tokens.join(by_row, "row").select(
        "key", "queue", "n", "ids",
        *(F.col(f"parts.{field}").alias(name) for field, name in (("start", "starts"), ("length", "lengths"), ("sent", "sent"))),
    )
    kinds = {name: met.schema[name].dataType.simpleString() for name in ("key", "queue", "n")}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in {**kinds, **dict.fromkeys(PIECE, "long")}.items())
    packed = met.mapInArrow(_pieces(settings.window), schema)
    return packed.select(
        F.col("key").alias(key), "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset",
        F.col("queue").alias(source),
    )


def _checked(shares: dict[str, float] | None) -> dict[str, float]:
    """The shares, which must be numbers from 0 on."""
    shares = {name: float(share) for name, share in (shares or {}).items()}
    if any(not 0 <= share < math.inf for share in shares.values()):
        raise ValueError(f"shares must be numbers from 0 on: {shares}")
    return shares


def production() -> Settings:
    import public_tokenizers

    return Settings(tokenizer=public_tokenizers.path("word_bpe_49k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), production())


QUERIES = {"op1_packing": op1_packing}
ORACLES: dict[str, str] = {}
