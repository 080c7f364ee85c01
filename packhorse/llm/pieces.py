"""Operator 8: SentencePiece encoding and decoding as a relational lattice.

Every distinct segment of the corpus is taken apart once: its substrings are
exploded and equi-joined to the piece table, the edges found are grouped by
segment, and one pass over them, best score first, folds them into the segment's
pieces: in numpy, for all segments of an Arrow batch side by side.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import unused
from packhorse.functions.digest import is_plain
from packhorse.llm.common import by_small_batches, give_back, stored, table

SPACE = "▁"
# Keys of edges: start * SPAN + length.
SPAN = 64
# Characters of a segment from which on its merges are not folded.
LONGEST = 60
# Characters of texts that one task puts together, and whose segments one task encodes.
BUCKET_CHARS = 12_000_000
PART_CHARS = 4_000_000
# Rows that a task puts together to bundles at a time.
BUNDLE_ROWS = 500_000
# Characters of the sample that frequent segments are taken from, and bytes of it that help to compress texts.
SAMPLE_CHARS = 20_000_000
DICTIONARY = 100_000


@dataclass(frozen=True)
class Pieces:
    """A model's pieces (text, id, score) and the ids of its 256 byte pieces."""

    rows: tuple[tuple[str, int, float], ...]
    bytes: tuple[int, ...]
    longest: int
    segment: str

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        rows = tuple(
            (model.id_to_piece(i), i, model.get_score(i)) for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        )
        of_byte = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
        longest = max(len(text) for text, _, _ in rows)
        if len(of_byte) != 256 or longest >= SPAN:
            raise ValueError("needs a model with byte fallback and pieces of less than 64 characters")
        return cls(rows, tuple(of_byte[f"<0x{b:02X}>"] for b in range(256)), longest, _segment(rows))

    @cached_property
    def code(self) -> str:
        """The type that ids have where they are packed into bytes."""
        return "<u2" if max(*self.bytes, *(i for _, i, _ in self.rows)) < 2**16 else "<i4"

    @cached_property
    def by_text(self) -> tuple[dict[str, float], dict[str, int]]:
        return self.scores(), self.names()

    @property
    def width(self) -> int:
        return np.dtype(self.code).itemsize

    def scores(self) -> dict[str, float]:
        return {text: score for text, _, score in self.rows}

    def names(self) -> dict[str, int]:
        return {text: i for text, i, _ in self.rows}


def _segment(rows: tuple[tuple[str, int, float], ...]) -> str:
    """A pattern that cuts text only where no piece can lie across.

    That is before a space mark that follows something else, and, where no piece
    has a letter beside another character, at the ends of runs of letters.
    """
    pairs = [(a, b) for text, _, _ in rows for a, b in zip(text, text[1:], strict=False)]
    if any(a != SPACE and b == SPACE for a, b in pairs):
        raise ValueError("a piece has a space after other characters")
    mixed = any(a.isalpha() != b.isalpha() for a, b in pairs if a != SPACE)
    return f"{SPACE}*[^{SPACE}]+|{SPACE}+" if mixed else rf"{SPACE}*\p{{L}}+|{SPACE}*[^\p{{L}}{SPACE}]+|{SPACE}+"


def segments_of(text: Column, pieces: Pieces) -> Column:
    """The segments of a text: spaces are marks, and one stands before the text if there is any."""
    marked = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    found = F.regexp_extract_all(marked, F.lit(pieces.segment), F.lit(0))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))


def lattice(segments: DataFrame, pieces: Pieces, longest: int = SPAN - 1) -> DataFrame:
    """Per `segment` its edges: a map from start and length of a substring that is a piece to score and id.

    Segments of more than `longest` characters have none. Others become some forty rows. Where segments are dealt by their text
    before, their edges need no shuffle; deal them to enough tasks.
    """
    spark = segments.sparkSession
    # As many rows as the vocabulary has, hence the hint.
    known = F.broadcast(spark.createDataFrame(list(pieces.rows), "piece string, id int, score double"))
    size = F.length("segment")
    whole = F.when(size <= longest, F.sequence(F.lit(0), size - 1)).otherwise(F.array(size))
    starts = segments.withColumn("start", F.explode(whole))
    lengths = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(pieces.longest), size - F.col("start"))))
    spans = starts.withColumn("length", F.explode(lengths))
    found = spans.withColumn("piece", F.col("segment").substr(F.col("start") + 1, F.col("length")))
    edge = F.struct((F.col("start") * SPAN + F.col("length")).alias("key"), F.struct("score", "id").alias("value"))
    # One row of each segment goes on in any case; of the others, those that are pieces.
    first = (F.col("length") == 1) & ((F.col("start") == 0) | (F.col("start") == size))
    met = found.join(known, "piece", "left").filter(F.col("id").isNotNull() | first)
    edges = met.select("segment", F.when(F.col("id").isNotNull(), edge).alias("edge"))
    return edges.groupBy("segment").agg(F.map_from_entries(F.collect_list("edge")).alias("edges"))


def _edge(edges: Column, start: Column, stop: Column) -> Column:
    return edges[start * SPAN + (stop - start)]


def merged(edges: Column, size: Column) -> Column:
    """Borders of the pieces of a BPE model: neighbours whose union has the best score merge first, the leftmost among equals."""

    def step(cuts: Column, _: Column) -> Column:
        inner = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(cuts) - 2))
        scores = F.transform(
            inner,
            lambda i: F.struct(
                _edge(edges, F.get(cuts, i - 1), F.get(cuts, i + 1))["score"].alias("score"), (-i).alias("left")
            ),
        )
        best = F.array_max(F.filter(scores, lambda one: one["score"].isNotNull()))
        at = -best["left"]
        fewer = F.concat(F.slice(cuts, F.lit(1), at), F.slice(cuts, at + 2, F.size(cuts)))
        return F.when(F.size(cuts) < 3, cuts).otherwise(F.coalesce(fewer, cuts))

    return F.aggregate(F.sequence(F.lit(1), size), F.sequence(F.lit(0), size), step)


def _bit(at: np.ndarray) -> np.ndarray:
    return np.left_shift(np.int64(1), at.astype(np.int64))


def _edges_of(edges: pa.MapArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all edges of a batch, by row, start and length: row, start, stop, score and id."""
    offsets = edges.offsets.to_numpy() if len(edges) else np.zeros(1, np.int32)
    rows, first, last = np.repeat(np.arange(len(edges)), np.diff(offsets)), offsets[0], offsets[-1]
    keys = edges.keys.slice(first, last - first).to_numpy().astype(np.int64)
    score, number = (one.to_numpy(zero_copy_only=False) for one in edges.items.slice(first, last - first).flatten())
    order = np.argsort(rows * SPAN * SPAN + keys)
    rows, keys = rows[order], keys[order]
    return rows, keys // SPAN, keys // SPAN + keys % SPAN, score[order], number[order]


def _in_order(edges: pa.MapArray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`merged_in_order` for the segments of a batch: of each, the edge next in order, all at a time."""
    cuts, odd = _bit(size + 1) - 1, np.zeros(len(size), bool)
    rows, start, stop, score, _ = _edges_of(edges)
    keys = (rows * SPAN + start) * SPAN + stop

    def better(row: np.ndarray, left: np.ndarray, right: np.ndarray, than: np.ndarray, there: np.ndarray) -> np.ndarray:
        wanted = (row * SPAN + left) * SPAN + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return there & (keys[at] == wanted) & (score[at] > than)

    wide = np.flatnonzero(stop - start > 1)
    wide = wide[np.lexsort((start[wide], -score[wide], rows[wide]))]
    own = rows[wide]
    turn = np.arange(len(wide)) - np.searchsorted(own, own)
    by_turn = np.argsort(turn, kind="stable")
    for now in np.split(wide[by_turn], np.cumsum(np.bincount(turn))[:-1]) if len(wide) else ():
        row, a, b = rows[now], start[now], stop[now]
        was, ends = cuts[row], _bit(a) | _bit(b)
        inner = was & (_bit(b) - _bit(a + 1))
        # Both ends are borders and one border lies between.
        fits = ((was & ends) == ends) & (inner != 0) & ((inner & (inner - 1)) == 0)
        row, a, b, than = row[fits], a[fits], b[fits], score[now[fits]]
        after = cuts[row] = was[fits] - inner[fits]
        below, above = after & (_bit(a) - 1), after & -_bit(b + 1)
        # The highest border below and the lowest above; doubles hold 32 bits, and powers of two, exactly.
        high = np.where(below >= 2**32, np.frexp((below >> 32).astype(float))[1] + 32, np.frexp(below.astype(float))[1]) - 1
        low = np.frexp((above & -above).astype(float))[1] - 1
        odd[row] |= better(row, high, b, than, below != 0) | better(row, a, low, than, above != 0)
    return cuts, odd


def merged_in_order(
    edges: Column, size: Column, segment: Column | None = None, pieces: Pieces | None = None, longest: int = LONGEST
) -> Column:
    """Borders as the bits of a long, from one pass over the edges, best score first; and whether it was enough.

    An edge merges if it then spans two neighbours. That misses a union that only a
    worse merge makes possible; a pass in which one came up is marked `odd`. With
    `segment` and `pieces` also the packed ids between these borders, `code`, for
    segments of more than `longest` characters from the merges of a heap.
    """
    coded = pieces is not None

    @F.arrow_udf("struct<cuts: bigint, odd: boolean" + coded * ", code: binary" + ">")
    def passed(edges: pa.Array, size: pa.Array, *segment: pa.Array) -> pa.Array:
        cuts, odd = _in_order(edges, size.to_numpy(zero_copy_only=False))
        told = [pa.array(cuts, pa.int64()), pa.array(odd, pa.bool_())]
        told += [_packed(segment[0], edges, cuts, pieces, longest)] if coded else []
        return pa.StructArray.from_arrays(told, ["cuts", "odd", "code"][: len(told)])

    return passed(edges, size, *([segment] if coded else []))


def viterbi(edges: Column, size: Column, longest: int, unknown: float = -1e6) -> Column:
    """Borders of the pieces of a unigram model: the path with the greatest sum of scores.

    A character that is no piece costs `unknown`; among equal sums the longer last piece wins.
    """
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.sequence(F.lit(0), F.lit(0)).alias("cuts")))

    def step(best: Column, stop: Column) -> Column:
        def arrive(start: Column) -> Column:
            cost = F.coalesce(_edge(edges, start, stop)["score"], F.when(start == stop - 1, F.lit(unknown)))
            return F.struct((F.get(best, start)["score"] + cost).alias("score"), (-start).alias("left"))

        ways = F.transform(F.sequence(F.greatest(F.lit(0), stop - longest), stop - 1), arrive)
        way = F.array_max(F.filter(ways, lambda one: one["score"].isNotNull()))
        cuts = F.concat(F.get(best, -way["left"])["cuts"], F.array(stop))
        return F.concat(best, F.array(F.struct(way["score"].alias("score"), cuts.alias("cuts"))))

    return F.aggregate(F.sequence(F.lit(1), size), first, step, lambda best: F.get(best, size)["cuts"])


def merge_long(segment: str, scores: dict[str, float]) -> list[str]:
    """The pieces of a BPE model for a long segment: the merges of `merged`, from a heap."""
    parts: list[str | None] = list(segment)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(parts) and (both := parts[left] + parts[right]) in scores:
            heapq.heappush(heap, (-scores[both], left, both))

    for left in range(len(parts) - 1):
        offer(left)
    while heap:
        _, left, both = heapq.heappop(heap)
        right = after[left] if parts[left] is not None else len(parts)
        if right >= len(parts) or parts[left] + parts[right] != both:
            continue
        parts[left], parts[right] = both, None
        after[left] = after[right]
        if after[left] < len(parts):
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [part for part in parts if part is not None]


def long_ids(segment: str, pieces: Pieces, scores: dict[str, float], names: dict[str, int]) -> list[int]:
    parts = merge_long(segment, scores)
    return [i for part in parts for i in ([names[part]] if part in names else [pieces.bytes[b] for b in part.encode()])]


def _long_code(segment: str, pieces: Pieces) -> bytes:
    return np.array(long_ids(segment, pieces, *pieces.by_text), pieces.code).tobytes()


def _packed(segments: pa.Array, edges: pa.MapArray, cuts: np.ndarray, pieces: Pieces, longest: int) -> pa.Array:
    """The packed ids of the pieces between borders; those of the bytes of a character that is no piece.

    Segments of more than `longest` characters have no edges and are merged from a heap.
    """
    rows, start, stop, _, number = _edges_of(edges)
    mine = cuts[rows]
    fits = ((mine >> start) & (mine >> stop) & 1 == 1) & (mine & (_bit(stop) - _bit(start + 1)) == 0)
    rows, covered, found = rows[fits], (stop - start)[fits], number[fits].astype(pieces.code)
    counts = np.bincount(rows, minlength=len(cuts))
    ends = np.concatenate([[0], np.cumsum(counts)]) * found.itemsize
    codes = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found.tobytes())])
    sizes = pc.utf8_length(segments).to_numpy(zero_copy_only=False)
    short = np.flatnonzero(np.bincount(rows, covered, len(cuts)) < sizes)
    if not len(short):
        return codes
    # Some characters of these are no pieces, or all are still to be merged.
    starts = start[fits]
    bounds, out = np.concatenate([[0], np.cumsum(counts)]), codes.to_pylist()
    for row in short.tolist():
        segment, here = segments[row].as_py(), slice(bounds[row], bounds[row + 1])
        if len(segment) > longest:
            out[row] = _long_code(segment, pieces)
            continue
        known = {at: (one, upto) for at, one, upto in zip(starts[here].tolist(), found[here].tolist(), covered[here].tolist(), strict=True)}
        ids, at = [], 0
        while at < len(segment):
            one, upto = known.get(at, (None, 1))
            ids += [pieces.bytes[b] for b in segment[at].encode()] if one is None else [one]
            at += upto
        out[row] = np.array(ids, pieces.code).tobytes()
    return pa.array(out, pa.binary())


def codes_of(segments: DataFrame, pieces: Pieces, longest: int = LONGEST, also_long: bool = True) -> DataFrame:
    """Per distinct `segment` its packed piece ids, `code`; null for those of more than `longest` characters if not `also_long`.

    One pass over a segment's edges in the order of their scores does for nearly
    all; the few that it marks are merged pair by pair. Long segments, which are
    rare, take the same merges from a heap, as their folds would take the square of
    their length.
    """
    size = F.length("segment")
    text = F.col("segment") if also_long else F.when(size <= longest, F.col("segment")).otherwise(F.lit(""))
    quick = lattice(segments.select("segment"), pieces, longest).withColumn(
        "pass", merged_in_order(F.col("edges"), F.least(size, F.lit(longest)), text, pieces, longest)
    )
    folded = quick.withColumn("cuts", F.when(F.col("pass.odd"), merged(F.col("edges"), size)))
    of_byte = F.array(*(F.lit(i) for i in pieces.bytes))

    def ids(i: Column) -> Column:
        start, stop = F.get("cuts", i - 1), F.get("cuts", i)
        code = F.hex(F.encode(F.col("segment").substr(start + 1, stop - start), "UTF-8"))
        raw = F.transform(
            F.sequence(F.lit(1), F.length(code), F.lit(2)),
            lambda at: F.get(of_byte, F.conv(F.substr(code, at, F.lit(2)), 16, 10).cast("int")),
        )
        one = _edge(F.col("edges"), start, stop)["id"]
        return F.when(one.isNotNull(), F.array(one)).otherwise(raw)

    def code(i: Column) -> Column:
        of_bytes = (F.lpad(F.hex(F.call_function("shiftright", i, F.lit(8 * k)).bitwiseAND(F.lit(255))), 2, "0") for k in range(pieces.width))
        return F.concat(*of_bytes)

    of_cuts = F.flatten(F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), ids))
    pairwise = F.unhex(F.array_join(F.transform(of_cuts, code), ""))
    codes = F.when(F.col("pass.odd"), pairwise).otherwise(F.col("pass.code"))
    return folded.select("segment", (codes if also_long else F.when(size <= longest, codes)).alias("code"))


def encode_segments(segments: DataFrame, pieces: Pieces, longest: int = LONGEST) -> DataFrame:
    """Per distinct `segment` its piece `ids`."""
    code, width = F.hex("code"), pieces.width

    def one(at: Column) -> Column:
        of_bytes = (F.substr(code, at + F.lit(2 * k), F.lit(2)) for k in reversed(range(width)))
        return F.conv(F.concat(*of_bytes), 16, 10).cast("int")

    unpacked = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2 * width)), one)
    return codes_of(segments, pieces, longest).select("segment", unpacked.alias("ids"))


class Cutter:
    """Cuts texts into units, which end before a space, and units into the segments of `segments_of`.

    `often` holds frequent segments; the others of a bucket are its rare ones.
    """

    def __init__(self, pieces: Pieces, often: pa.Array):
        self.units = re.compile(" *[^ ]+| +").findall
        self.segments = regex.compile(pieces.segment).findall
        self.by_letters = "L" in pieces.segment
        self.mark, self.often = SPACE.encode(), often
        # Arrow may know another edition of Unicode; what matters is that it tells the letters in pieces.
        held = sorted({char for text, _, _ in pieces.rows for char in text})
        self.letters = pc.utf8_is_alpha(pa.array(held, pa.string())).to_pylist() == [char.isalpha() for char in held]

    def units_of(self, texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct units of some texts, marks for spaces, the numbers of all units in order, and how many each text has.

        Arrow splits and numbers what stands between single spaces. Texts with other
        spaces are cut one by one.
        """
        texts = [text and text.replace(self.mark, b" ") for text in texts]
        odd = [i for i, text in enumerate(texts) if text and (text[:1] == b" " or text[-1:] == b" " or b"  " in text)]
        even = list(texts)
        for i in odd:
            even[i] = None
        words = pc.split_pattern(pa.array([text or None for text in even], pa.binary()).cast(pa.string()), " ")
        numbered = words.flatten().dictionary_encode()
        units = pc.binary_join_element_wise(SPACE, numbered.dictionary, "")
        numbers, counts = numbered.indices.to_numpy(), pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)
        if odd:
            known, ends, parts, at = {unit: n for n, unit in enumerate(units.to_pylist())}, np.cumsum(counts), [], 0
            for i in odd:
                found = self.units(f" {texts[i].decode()}")
                own = [known.setdefault(unit.replace(" ", SPACE), len(known)) for unit in found]
                parts += [numbers[at : ends[i]], np.array(own, np.int32)]
                at, counts[i] = ends[i], len(own)
            units, numbers = pa.array(known, pa.string()), np.concatenate([*parts, numbers[at:]])
        return units, numbers, counts

    def _ways(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which units are one segment, and which are one and a last character."""
        word = pc.utf8_slice_codeunits(units, 1)
        one = pc.is_in(units, self.often)
        if not self.letters:
            return one.to_numpy(zero_copy_only=False), np.zeros(len(units), bool)
        # A space and letters are one segment, as is what is known as one.
        one = pc.or_(one, pc.utf8_is_alpha(word)).to_numpy(zero_copy_only=False)
        if not self.by_letters:
            return one, np.zeros(len(units), bool)
        two = pc.and_not(pc.utf8_is_alpha(pc.utf8_slice_codeunits(word, 0, -1)), pc.ends_with(word, SPACE))
        return one, two.to_numpy(zero_copy_only=False) & ~one

    def cut(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """How many segments each unit has, the numbers of all in order, and the distinct segments."""
        one, two = self._ways(units)
        rest = [self.segments(unit) for unit in units.filter(pa.array(~one & ~two)).to_pylist()]
        counts = np.where(one, 1, 2)
        counts[~one & ~two] = [len(found) for found in rest]
        first = np.cumsum(counts) - counts
        at = [first[one], first[two], first[two] + 1, _runs(first[~one & ~two], counts[~one & ~two])]
        ends = units.filter(pa.array(two))
        found = [units.filter(pa.array(one)), pc.utf8_slice_codeunits(ends, 0, -1), pc.utf8_slice_codeunits(ends, -1)]
        found.append(pa.array([segment for segments in rest for segment in segments], pa.string()))
        met = pa.concat_arrays(found).dictionary_encode()
        numbers = np.empty(len(met), np.int32)
        numbers[np.concatenate(at)] = met.indices.to_numpy()
        return counts, numbers, met.dictionary

    def rare(self, segments: pa.Array) -> np.ndarray:
        """The numbers of the rare ones of distinct segments, in the order of their texts."""
        rare = np.flatnonzero(~pc.is_in(segments, self.often).to_numpy(zero_copy_only=False))
        return rare[pc.array_sort_indices(segments.take(pa.array(rare))).to_numpy()]


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, laid end to end."""
    before = np.cumsum(lengths, dtype=np.int64) - lengths
    total = int(before[-1] + lengths[-1]) if len(lengths) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0)) + int(lengths.max(initial=0))) < 2**31 else np.int64
    runs = np.arange(total, dtype=kind)
    runs += np.repeat((starts - before).astype(kind), lengths)
    return runs


def _bundled(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of bucket, place and code as one row for each bucket: their places, numbers of ids and ids, compressed."""

    def bundles(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids, starts, lengths = _ids_in(pa.concat_arrays([pa.array([], pa.binary()), *rows.column("code").chunks]), kind)
        buckets, places = rows.column("bucket").to_numpy(), rows.column("place").to_numpy()
        order = np.lexsort((places, buckets))
        ids, lengths = ids[_runs(starts[order].astype(np.int64), lengths[order])], lengths[order]
        numbers, first = np.unique(buckets[order], return_index=True)
        borders, ends = [*first.tolist(), len(order)], np.concatenate([[0], np.cumsum(lengths)])
        # Places differ little from one row to the next.
        steps, squeeze = np.diff(places[order], prepend=0), zstandard.ZstdCompressor(level=3).compress
        steps[first] = places[order][first]
        steps, lengths = steps.astype("<u4"), lengths.astype("<u4")
        made = [
            squeeze(np.uint32(b - a).tobytes() + steps[a:b].tobytes() + lengths[a:b].tobytes() + ids[ends[a] : ends[b]].tobytes())
            for a, b in zip(borders[:-1], borders[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(made, pa.binary())], names=["bucket", "found"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch] if batch.num_rows else held, rows + batch.num_rows
            if rows >= BUNDLE_ROWS:
                yield from bundles(held)
                held, rows = [], 0
        if held:
            yield from bundles(held)
        give_back()

    return work


def _unbundled(found: Iterable[bytes], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all rows in bundles: the places, the numbers of ids, and the ids end to end."""
    expand, parts = zstandard.ZstdDecompressor().decompress, [(np.zeros(0, "<u4"), np.zeros(0, "<u4"), np.zeros(0, kind))]
    for body in map(expand, found):
        rows = int(np.frombuffer(body, "<u4", 1)[0])
        counts = np.frombuffer(body, "<u4", 2 * rows, 4)
        parts.append((np.cumsum(counts[:rows], dtype=np.int64), counts[rows:], np.frombuffer(body, kind, offset=4 + 8 * rows)))
    places, lengths, ids = (np.concatenate(one) for one in zip(*parts, strict=True))
    return places.astype(np.int64), lengths.astype(np.int64), ids


def _ids_in(codes: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids in all of some packed ones, and where each begins in there and how many it has."""
    if not len(codes):
        return np.zeros(0, kind), np.zeros(0, np.int32), np.zeros(0, np.int32)
    _, ends, body = codes.buffers()
    offsets = np.frombuffer(ends, np.int32, len(codes) + 1, 4 * codes.offset) // np.dtype(kind).itemsize
    return np.frombuffer(body, kind, int(offsets[-1])), offsets[:-1], np.diff(offsets)


class Squeezer:
    """Compresses short texts with a sample of the others as dictionary."""

    def __init__(self, sample: bytes):
        content = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if sample else None
        self.small = zstandard.ZstdCompressor(level=5, dict_data=content).compress
        self.large = zstandard.ZstdDecompressor(dict_data=content).decompress


def _squeezed(small: str, sample: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last column, of texts, compressed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = Squeezer(sample.value).small
        for batch in batches:
            texts = pa.array([text and squeeze(text) for text in batch.columns[-1].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*batch.schema.names[:-1], small])
        give_back()

    return work


def _sample(df: DataFrame, whole: Column, chars: int) -> DataFrame:
    """Rows with about `SAMPLE_CHARS` characters; which they are changes no result."""
    share = min(1.0, SAMPLE_CHARS / max(1, chars))
    return df.filter(F.pmod(F.xxhash64(whole, F.lit(7)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def _frequent(sample: DataFrame, whole: Column, pieces: Pieces, most: int) -> tuple[pa.Array, pa.Array]:
    """The segments that most texts of the sample hold, and their packed ids."""
    rows = []
    if most:
        held = sample.select(F.explode(F.array_distinct(segments_of(whole, pieces))).alias("segment"))
        counted = held.groupBy("segment").agg(F.count(F.lit(1)).alias("texts"))
        first = stored(counted.orderBy(F.desc("texts"), "segment").limit(most).select("segment"), "frequent")
        rows = encode_segments(first, pieces).collect()
    codes = [np.array(row["ids"], pieces.code).tobytes() for row in rows]
    return pa.array([row["segment"] for row in rows], pa.string()), pa.array(codes, pa.binary())


def encode(
    df: DataFrame, pieces: Pieces, text: str = "text", out: str = "ids", frequent: int = 200_000, keep_text: bool = True
) -> DataFrame:
    """`df` with `out`, the piece ids of each whole text; without the text if it need not be kept.

    Texts are dealt, compressed, to buckets of about `BUCKET_CHARS` characters. What
    segments a bucket holds is listed there, every segment of the corpus is encoded
    once, and its ids go back to the buckets that listed it, where texts are put
    together. At most `frequent` segments, which a sample shows to be frequent, are
    broadcast and not listed. Null and empty texts have no ids; copies of a text
    are spread over buckets by their other columns and their place; a column that is
    already named `out` is replaced, all others stay, whatever their names, and an
    empty table gives an empty one.
    """
    spark = by_small_batches(df).sparkSession
    bucket, small = (unused(name, [*df.columns, out]) for name in ("bucket", "small"))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    chars = df.agg(F.sum(F.length(whole))).first()[0] or 0
    sample = _sample(df, whole, chars)
    often = spark.sparkContext.broadcast(_frequent(sample, whole, pieces, frequent))
    some = [row[0] or "" for row in sample.select(F.substring(whole, 1, DICTIONARY)).limit(50).collect()]
    dictionary = spark.sparkContext.broadcast("".join(some).encode()[:DICTIONARY])

    buckets, parts = 1 + chars // BUCKET_CHARS, 1 + chars // PART_CHARS
    kept = [field for field in df.schema.fields if field.name not in (out, text)]
    plain = [F.col(f"`{field.name}`") for field in kept if is_plain(field.dataType)]
    # The place keeps equal rows of different parts of the table apart.
    place = F.pmod(F.xxhash64(*plain, whole, F.spark_partition_id()), F.lit(buckets)).alias(bucket)
    columns = [F.col(f"`{field.name}`") for field in kept]
    rows = df.select(*columns, place, F.col(f"`{text}`").cast("binary").alias(small))
    ddl = T.StructType([*kept, T.StructField(bucket, T.LongType()), T.StructField(small, T.BinaryType())])
    dealt = rows.mapInArrow(_squeezed(small, dictionary), ddl).repartition(int(buckets), bucket)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, expand = Cutter(pieces, often.value[0]), Squeezer(dictionary.value).large
        # Compressed until their turn, as several buckets may meet in a task.
        bodies: dict[int, list[bytes | None]] = {}
        for batch in batches:
            for number, body in zip(batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist(), strict=True):
                bodies.setdefault(number, []).append(body)
        for number in list(bodies):
            units, _, _ = cutter.units_of([body and expand(body) for body in bodies.pop(number)])
            _, _, segments = cutter.cut(units)
            names = segments.take(pa.array(cutter.rare(segments)))
            columns = [pa.array(np.full(len(names), number)), pa.array(np.arange(len(names))), names]
            far = pc.greater(pc.utf8_length(names), LONGEST).to_pylist()
            long = [_long_code(names[i].as_py(), pieces) if is_far else None for i, is_far in enumerate(far)]
            columns.append(pa.array(long, pa.binary()))
            del units, segments
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "place", "segment", "long"])
            del names, columns, long
            give_back()

    # One exchange, by segment, for the distinct segments and for the way back: Spark
    # reads it twice as long as both want all columns.
    asked = dealt.mapInArrow(listed, "bucket long, place long, segment string, long binary").repartition(int(parts), "segment")
    once = asked.groupBy("segment").agg(F.max("bucket").alias("last"), F.max("place").alias("late"), F.count("long").alias("longs"))
    encoded = codes_of(once.filter("last >= 0 AND late >= 0 AND longs >= 0"), pieces, also_long=False)
    # A part's segments are few enough to be hashed, so its rows need no sort.
    told = asked.join(encoded.hint("shuffle_hash"), "segment").select("bucket", "place", F.coalesce("code", "long").alias("code"))
    back = told.mapInArrow(_bundled(pieces.code), "bucket long, found binary")

    back_again = keep_text and text != out
    again = [T.StructField(text, T.StringType())] if back_again else []
    made = T.StructType([*kept, *again, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def put_together(texts: pa.Table, found: pa.Table) -> pa.Table:
        cutter, expand = Cutter(pieces, often.value[0]), Squeezer(dictionary.value).large
        bodies = texts.column(small).to_pylist()
        units, numbers, counts = cutter.units_of([body and expand(body) for body in bodies])
        parts, inside, segments = cutter.cut(units)
        del units
        rare = cutter.rare(segments)
        places, own_lengths, more = _unbundled(found.column("found").to_pylist(), pieces.code)
        if len(rare) != len(places):
            raise RuntimeError(f"{len(rare)} segments of a bucket, {len(places)} encoded")
        # Where the ids of each distinct segment are, first those of the frequent ones.
        ids, starts, lengths = _ids_in(often.value[1], pieces.code)
        at = pc.index_in(segments, cutter.often).fill_null(0).to_numpy()
        begin, size = (one[at].astype(np.int64) if len(one) else np.zeros(len(at), np.int64) for one in (starts, lengths))
        own = rare[places]
        begin[own], size[own] = np.cumsum(own_lengths) - own_lengths + len(ids), own_lengths
        ids = np.concatenate([ids, more])
        del segments, rare, at, own, more, starts, lengths, places, own_lengths
        # The ids of distinct units laid end to end, and from them those of all units in order.
        each = size[inside]
        of_units = ids[_runs(begin[inside], each)].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(parts)])]
        del ids, each, inside, begin, size
        starts, lengths = ends[:-1], np.diff(ends)
        each = lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])[np.concatenate([[0], np.cumsum(counts)])]
        values = pa.array(of_units[_runs(starts[numbers], each)])
        del numbers, each, of_units
        give_back()
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        again = [pa.array([body and expand(body) for body in bodies], pa.binary()).cast(pa.string())] if back_again else []
        return pa.table([*(texts.column(field.name) for field in kept), *again, lists], names=made.names)

    met = dealt.groupBy(bucket).cogroup(back.groupBy("bucket")).applyInArrow(put_together, made)
    names = [name for name in df.columns if keep_text or name != text or name == out]
    names += [] if out in names else [out]
    return met.select(*[F.col(f"`{name}`") for name in names])


def decode(df: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "text") -> DataFrame:
    """`df` with `out`, the texts of `ids`; null and empty ids are the empty text.

    The space before a text is taken off again. Bytes that are no valid UTF-8 become replacement characters.
    """
    spark = df.sparkSession
    rows = [(i, text.encode().hex()) for text, i, _ in pieces.rows] + [(i, f"{b:02x}") for b, i in enumerate(pieces.bytes)]
    # As many rows as the vocabulary has, hence the hint.
    codes = F.broadcast(spark.createDataFrame(rows, "id int, code string"))
    numbered = stored(df.withColumn("_piece_row", F.monotonically_increasing_id()), "decoded")
    parts = numbered.select("_piece_row", F.posexplode(ids).alias("pos", "id")).join(codes, "id")
    texts = parts.groupBy("_piece_row").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda one: one["code"]), "").alias("_piece_code")
    )
    text = F.replace(F.decode(F.unhex("_piece_code"), "UTF-8"), F.lit(SPACE), F.lit(" "))
    return (
        numbered.join(texts, "_piece_row", "left")
        .withColumn(out, F.coalesce(F.substr(text, F.lit(2)), F.lit("")))
        .select(*df.columns, *([] if out in df.columns else [out]))
    )


def production() -> Pieces:
    import public_tokenizers

    return Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), production(), keep_text=False)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


QUERIES = {"op8_pieces": op8_pieces}
ORACLES: dict[str, str] = {}
