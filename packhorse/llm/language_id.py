"""Operator 10: language by compression with one dictionary per language.

Text in a language compresses best with a dictionary of that language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.llm.common import bounded_broadcast, by_small_batches, give_back, held_out, in_training, stored, table

UNKNOWN = "und"
# Parts that the texts of a language are ranked in first.
SALTS = 16


@dataclass(frozen=True)
class Settings:
    """`docs` texts per language, `slice_chars` of each, make its dictionary.

    Every language is learned. The fit sends at most `languages * docs * slice_chars`
    characters to the driver at a time, and a task holds the encoders of `languages`
    languages at a time. Texts are compressed in chunks of `chunk` bytes, as the dictionary would matter less
    and less further into a long text. A margin below `min_margin` is narrow; then
    the sizes at the levels `again` are added, as those of a short text at one
    level are often equal, and the margin is taken anew.
    """

    docs: int = 400
    slice_chars: int = 2000
    languages: int = 200
    level: int = 6
    again: tuple[int, ...] = (1, 3, 4, 5)
    chunk: int = 2048
    min_margin: float = 0.002


RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def fit(df: DataFrame, settings: Settings, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Dictionaries from texts with a language; which texts is decided by a hash of the id.

    First the hashes alone are ranked, limited in each map task, in `SALTS` parts of
    a language and then in all, so that no task ranks more than `SALTS * docs` rows
    a language however many tasks read the table; then the chosen texts are read,
    once for as many languages as may be sent to the driver together. Rows without a
    language or a text are left out, repeated rows count once, a null key is a key
    like any other; other columns are left aside, whatever their names, and an
    empty table gives no dictionary.
    """
    known = df.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.lit(17)).alias("h"), F.col(text).alias("text")
    )
    ranked = known.select("lang", "h").withColumn("salt", F.pmod(F.col("h"), F.lit(SALTS)))
    for parts in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*parts).orderBy("h")
        ranked = ranked.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= settings.docs)
    few = stored(ranked.groupBy("lang").agg(F.max("h").alias("most"), F.count(F.lit(1)).alias("n")), "languages")
    # The middle of a text, not its opening, which templates share.
    size = settings.slice_chars
    middle = F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - size // 2)
    chosen = known.join(bounded_broadcast(few), "lang").filter("h <= most").groupBy("lang", "h").agg(
        F.min(F.substring(F.col("text"), middle, F.lit(size))).alias("part")
    )
    learned: dict[str, list[str]] = {}
    together: list[list[str]] = []
    held = most = settings.languages * settings.docs
    for row in few.orderBy("lang").collect():
        if held + row["n"] > most:
            together.append([])
            held = 0
        together[-1].append(row["lang"])
        held += row["n"]
    for names in together:
        for row in chosen.filter(F.col("lang").between(names[0], names[-1])).orderBy("lang", "h").collect():
            learned.setdefault(row["lang"], []).append(row["part"].lower())
    return {name: " ".join(reversed(values)).encode() for name, values in learned.items()}


def _winner(sizes: list[int]) -> tuple[int, float]:
    """The place of the smallest size, and by how much the next is larger."""
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    return best, 1 - sizes[best] / min(size for i, size in enumerate(sizes) if i != best)


class Encoders:
    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.names = sorted(dictionaries)
        self.settings = settings
        self.dictionaries = dictionaries
        self.at_level: dict[int, list[zstandard.ZstdCompressor]] = {}

    def made(self, names: list[str], level: int) -> list[zstandard.ZstdCompressor]:
        out = []
        for name in names:
            content = zstandard.ZstdCompressionDict(self.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            out.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        return out

    def encoders(self, level: int) -> Iterator[list[zstandard.ZstdCompressor]]:
        """One encoder per language, by groups of languages.

        If there is one group only, it is made when a level is first asked for, and kept.
        """
        most = self.settings.languages
        if len(self.names) <= most:
            if level not in self.at_level:
                self.at_level[level] = self.made(self.names, level)
            yield self.at_level[level]
        else:
            for at in range(0, len(self.names), most):
                yield self.made(self.names[at : at + most], level)

    def sizes(self, texts: list[str], level: int) -> list[list[int]]:
        """For each text its size with every language."""
        step = self.settings.chunk
        out: list[list[int]] = [[] for _ in texts]
        for group in self.encoders(level) if texts else ():
            for text, found in zip(texts, out, strict=True):
                data = text.lower().encode()
                chunks = [data[at : at + step] for at in range(0, len(data), step)]
                found += [sum(len(one.compress(chunk)) for chunk in chunks) for one in group]
        return out

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        out = [(UNKNOWN, 0.0, 0.0, False)] * len(texts)
        known = [at for at, text in enumerate(texts) if text and self.names and any(map(str.isalpha, text))]
        if len(self.names) == 1:
            for at in known:
                out[at] = self.names[0], 1.0, 1.0, True
            return out
        least = self.settings.min_margin
        sizes = dict(zip(known, self.sizes([texts[at] for at in known], self.settings.level), strict=True))
        narrow = [at for at in known if _winner(sizes[at])[1] < least]
        for level in self.settings.again:
            for at, more in zip(narrow, self.sizes([texts[at] for at in narrow], level), strict=True):
                sizes[at] = [a + b for a, b in zip(sizes[at], more, strict=True)]
        for at in known:
            best, margin = _winner(sizes[at])
            score = 1 / sum(math.exp((sizes[at][best] - size) / (0.02 * sizes[at][best])) for size in sizes[at])
            out[at] = self.names[best], score, margin, margin >= least
        return out


def language_id(
    df: DataFrame, dictionaries: dict[str, bytes], settings: Settings, text: str = "text", out: str = "language"
) -> DataFrame:
    """`df` with a struct `out`: the language, a score from 0 to 1, the margin, and `accepted`.

    Whole texts are compressed. A null or empty text, or one without a letter,
    is `und` and not accepted; so is every text when nothing was learned. Equal
    sizes go to the language that sorts first, with margin 0. Numbers are no letters,
    in any script. A column that is already named `out` is replaced; an empty table gives an empty one.
    """

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = Encoders(dictionaries, settings)
        for texts in batches:
            yield pd.DataFrame(encoders.judge(list(texts)), columns=RESULT.names)
        del encoders
        give_back()

    return by_small_batches(df).withColumn(out, judge(F.col(text)))


def fit_documents(docs: DataFrame, settings: Settings) -> dict[str, bytes]:
    return fit(docs.filter(in_training("doc_id")), settings)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents"), Settings()
    told = language_id(docs.select("doc_id", "text"), fit_documents(docs, settings), settings)
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "language.*")


QUERIES = {"op10_language_id": op10_language_id}
ORACLES: dict[str, str] = {}
