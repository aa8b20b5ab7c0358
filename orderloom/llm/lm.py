"""Language-model scoring from a log-frequency Bloom filter of n-gram counts.

Training texts give exact counts of their tokens and counts of pairs of
neighbouring tokens. A pair with count c has level 1 + floor(log2 c); the filter
holds the events (pair, 1) ... (pair, level). A query probes level after level
until one is missing, so a pair's count is known up to a factor of two, never
too low, and too high only by chance. Pairs cannot be more frequent than their
tokens, which the exact counts use to correct most chance hits.

    P(w | u) = (c(u, w) + prior * P1(w)) / (c(u) + prior),  P1(w) = (c(w) + 1) / (N + V + 1)

The filter consists of segments of a fixed size, as many as the training tokens
ask for. Every pair lies in one segment, and a few neighbouring segments are built
by one grouped task, so no task holds the whole filter. Tasks send their counts of
pairs packed, a row for each of these groups. Segments and token counts go to
all workers in shards of at most ``shard_bytes``, as flat files that workers map
into memory: neither the driver nor a worker holds a shard, and the workers of a
node share its pages. Where the shared folder is mounted, the files are mapped in
place; from other stores Spark copies them to each executor. Texts are read and
split once, however many shards there are: the pairs of a batch are put in order
of their segments and probed shard after shard, and nothing is written in between.

Defined cases: a null or empty text is scored as its end alone; a null id counts
as the empty string; without training texts every count is 0.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.files import Sink, mounted_path, open_input, own_file
from orderloom.llm.words import bytewise, combine, mix, split_words
from orderloom.operators.storage import materialize, new_folder

END, BEGIN = np.uint64(0x5E9D3C1F7A2B8841), np.uint64(0xB1A6F00D2C4E9377)
SEGMENT_BITS = 1 << 19
GROUPED = 16
# A pair seen n times makes 1 + floor(log2(n)) <= n events, so there are at most as many events as
# tokens, and each has 8 bits or more: of unseen pairs at most (1 - exp(-4 / 8)) ** 4, 2.4 %, pass as seen.
BITS_PER_TOKEN = 8
PROBES = 4
SHARD_BYTES = 192 << 20
WORD_BYTES = 12
MOST_HELD = 1_000_000
TEXT_BYTES = 2 << 20


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """One fold of the texts by a checksum of the id, as text, is not learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a batch, each text closed by END; the token before each; row bounds."""
    words = split_words(column)
    n = len(words.rows) - 1
    rows = words.rows + np.arange(n + 1)
    tokens = np.full(int(rows[-1]), END)
    tokens[np.arange(len(words.hashes)) + words.row_of()] = words.hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[rows[:-1]] = BEGIN
    return tokens, before, rows


def pairs_of(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return combine(before, tokens)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of the weights of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)


class _Counter:
    """Counts of 64-bit keys, handed on whenever it holds many, so its size is bounded."""

    def __init__(self):
        self.keys, self.counts, self.waiting, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n > MOST_HELD:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *self.waiting])
        weights = np.ones(len(keys), np.int64)
        weights[: len(self.keys)] = self.counts
        self.keys, self.counts = _summed(keys, weights)
        self.waiting, self.n = [], 0

    def hand_on(self, all_of_it: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if all_of_it:
            self.merge()
        if len(self.keys) and (all_of_it or len(self.keys) > MOST_HELD):
            yield self.keys, self.counts
            self.keys, self.counts = self.keys[:0], self.counts[:0]


def _count_with(keys_of, shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in bytewise(batches, "text", TEXT_BYTES):
            tokens, before, _ = tokens_of(batch.column(0))
            counter.add(keys_of(before, tokens))
            yield from map(shape, counter.hand_on(False))
        yield from map(shape, counter.hand_on(True))

    return run


def token_counts(texts: DataFrame) -> DataFrame:
    """``token`` (hash) and its count ``n`` in the whole corpus."""

    def shape(found):
        return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1])], names=["token", "n"])

    counted = texts.mapInArrow(_count_with(lambda before, tokens: tokens, shape), "token bigint, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _segment(pairs: np.ndarray, segments: int) -> np.ndarray:
    return ((pairs >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def _bits(pairs: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """The places of an event inside its segment, probe by probe."""
    h = mix(pairs + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    place = h & np.uint64(SEGMENT_BITS - 1)
    step = (h >> np.uint64(40)) | np.uint64(1)
    for _ in range(PROBES):
        yield place.astype(np.int64)
        place = (place + step) & np.uint64(SEGMENT_BITS - 1)


def _start(segment: np.ndarray, segments: int) -> np.ndarray:
    """How many of the 2**32 upper halves of pairs lie in earlier segments."""
    each, more = divmod(1 << 32, segments)
    return segment * np.uint64(each) + np.minimum(segment, np.uint64(more))


def _placed(pairs: np.ndarray, segments: int) -> np.ndarray:
    """Pairs renumbered one to one, so that they are in order of their segments."""
    high, low = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
    turn = high // np.uint64(segments)
    return (_start(high - turn * np.uint64(segments), segments) + turn) << np.uint64(32) | low


def _found_at(placed: np.ndarray, low: int, high: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that ``_placed`` renumbered, all of the segments from ``low`` to ``high``; the lines of these after ``low``."""
    starts = _start(np.arange(low, high, dtype=np.uint64), segments)
    rank = placed >> np.uint64(32)
    line = np.searchsorted(starts, rank, side="right") - 1
    upper = (rank - starts[line]) * np.uint64(segments) + (line + low).astype(np.uint64)
    return upper << np.uint64(32) | placed & np.uint64(0xFFFFFFFF), line


def _pack(placed: np.ndarray, counts: np.ndarray, start: int) -> bytes:
    """Ascending numbers and their counts as compressed planes: of differences and counts the upper bytes are mostly 0."""
    columns = np.stack([np.diff(placed, prepend=np.uint64(start)), counts.view(np.uint64)])
    return pa.compress(np.ascontiguousarray(columns.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1)), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(packed, 16 * n, codec="zstd"), np.uint8).reshape(2, 8, n)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64).reshape(2, n)
    return np.cumsum(steps) + np.uint64(start), counts.view(np.int64)


def _group_start(group: int, segments: int) -> int:
    return int(_start(np.array([group * GROUPED], np.uint64), segments)[0]) << 32


def _build_group(segments: int, folder: str):
    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        start, low = _group_start(group, segments), group * GROUPED
        high = min(low + GROUPED, segments)
        rows = zip(table.column("packed").to_pylist(), table.column("n").to_pylist())
        placed, counts = _summed(*map(np.concatenate, zip(*[_unpack(packed, n, start) for packed, n in rows])))
        pairs, line = _found_at(placed, low, high, segments)
        levels = 1 + np.floor(np.log2(counts)).astype(np.int64)
        bits = np.zeros((high - low, SEGMENT_BITS), bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            at = np.flatnonzero(levels >= level)
            for place in _bits(pairs[at], level):
                bits[line[at], place] = True
        sink = Sink(own_file(folder, ".bits"))
        sink.write(np.packbits(bits, axis=1).tobytes())
        sink.close()
        return pa.table({"group": pa.array([group], pa.int64()), "path": [sink.path]})

    return run


def packed_pairs(texts: DataFrame, segments: int) -> DataFrame:
    """What tasks have counted: a row for each ``group`` of segments with the ``n`` pairs there and their counts, ``packed``."""

    def shape(found):
        placed, counts = found
        groups = range(-(-segments // GROUPED))
        starts = [_group_start(g, segments) for g in groups]
        edges = [*np.searchsorted(placed, np.array(starts, np.uint64)).tolist(), len(placed)]
        rows = [(g, b - a, _pack(placed[a:b], counts[a:b], starts[g])) for g, a, b in zip(groups, edges, edges[1:]) if b > a]
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(arrays, names=["group", "n", "packed"])

    keys = _count_with(lambda before, tokens: _placed(pairs_of(before, tokens), segments), shape)
    return texts.mapInArrow(keys, "group bigint, n bigint, packed binary")


def pair_filter(texts: DataFrame, segments: int) -> dict[int, str]:
    """The filter's segments: for each ``group`` of neighbouring ones that has pairs, the file with their bits."""
    build = _build_group(segments, new_folder(texts.sparkSession, "pair-filter"))
    built = packed_pairs(texts, segments).groupBy("group").applyInArrow(build, "group bigint, path string")
    return {row.group: row.path for row in built.collect()}


@dataclass
class Shard:
    """Some of the token counts and a run of the filter's segments."""

    tokens: np.ndarray  # sorted
    counts: np.ndarray
    first: int
    bits: np.ndarray  # a line per segment from ``first`` on

    @staticmethod
    def mapped(path: str) -> Shard:
        """A local copy of a shard's file, mapped into memory."""
        data = np.memmap(path, np.uint8, "r")
        n, width, first, lines = data[:32].view(np.int64).tolist()
        ends = 32 + 8 * n, 32 + (8 + width) * n
        tokens, counts = data[32 : ends[0]].view(np.uint64), data[ends[0] : ends[1]].view(f"u{width}")
        return Shard(tokens, counts, first, data[ends[1] :].reshape(lines, SEGMENT_BITS // 8))

    def token_counts(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        place = np.searchsorted(self.tokens, tokens)
        place[place == len(self.tokens)] = 0
        return np.where(self.tokens[place] == tokens, self.counts[place], 0).astype(np.int64)

    def levels(self, pairs: np.ndarray, segments: int) -> np.ndarray:
        """Repeated membership probes: the highest level up to which all events are there."""
        out = np.zeros(len(pairs), np.int64)
        line = _segment(pairs, segments) - self.first
        at = np.flatnonzero((line >= 0) & (line < len(self.bits)))
        level = 1
        while len(at) and level < 64:
            there = np.ones(len(at), bool)
            for place in _bits(pairs[at], level):
                byte = self.bits[line[at], place >> 3]
                there &= (byte >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            at = at[there]
            out[at] = level
            level += 1
        return out


@dataclass(frozen=True)
class Model:
    """Token counts as a written table, the filter as written files, and the totals that scoring needs."""

    counts: DataFrame
    filter: dict[int, str]
    train_tokens: int
    train_texts: int
    distinct: int
    segments: int
    shards: int
    prior: float

    @property
    def each(self) -> int:
        """Segments a shard."""
        return -(-self.segments // self.shards)

    def write_shard(self, k: int) -> str:
        """One shard as a flat file in the shared folder, a piece at a time; returns its path."""
        spark = self.counts.sparkSession
        own = self.counts.where(F.pmod("token", F.lit(self.shards)) == k).toArrow()
        tokens, counts = own.column("token").to_numpy().view(np.uint64), own.column("n").to_numpy()
        order = np.argsort(tokens)
        width = 4 if counts.max(initial=0) < 1 << 32 else 8
        first = k * self.each
        end = max(first, min(first + self.each, self.segments))
        sink = Sink(f"{new_folder(spark, 'shard')}/shard-{uuid.uuid4().hex}")
        sink.write(np.array([len(order), width, first, end - first], np.int64).tobytes())
        sink.write(tokens[order].tobytes())
        sink.write(counts[order].astype(f"u{width}").tobytes())
        line = SEGMENT_BITS // 8
        while first < end:
            group = first // GROUPED
            low, stop = group * GROUPED, min(end, (group + 1) * GROUPED)
            if group in self.filter:
                with open_input(self.filter[group]) as file:
                    file.seek((first - low) * line)
                    sink.write(file.read((stop - first) * line))
            else:
                sink.write(bytes((stop - first) * line))
            first = stop
        sink.close()
        return sink.path


def train(texts: DataFrame, prior: float = 100.0, shard_bytes: int = SHARD_BYTES) -> Model:
    """Learn from all rows of ``texts`` (column ``text``)."""
    texts = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = materialize(token_counts(texts), "token-counts")
    end = F.max(F.when(F.col("token") == int(END.astype(np.int64)), F.col("n")))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), end.alias("texts")).first()
    n, distinct = total["n"] or 0, total["v"]
    segments = max(1, -(-n * BITS_PER_TOKEN // SEGMENT_BITS))
    pairs = pair_filter(texts, segments)
    size = segments * SEGMENT_BITS // 8 + distinct * WORD_BYTES
    return Model(counts, pairs, n, total["texts"] or 0, distinct, segments, max(1, -(-size // shard_bytes)), prior)


SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def _dealt(place: np.ndarray, edges: np.ndarray) -> Iterator[np.ndarray]:
    """Where the places between two edges are, in their order, for all neighbouring edges."""
    order = np.argsort(place)
    cuts = np.searchsorted(place[order], edges)
    for a, b in zip(cuts, cuts[1:]):
        yield order[a:b]


def _within_reach(context: SparkContext, path: str) -> str:
    """What ``_local`` needs to find a file of the shared folder on any node."""
    mounted = mounted_path(path)
    if mounted is None:
        context.addFile(path)
    return mounted or path.rsplit("/", 1)[1]


def _local(file: str) -> str:
    return file if file.startswith("/") else SparkFiles.get(file)


def _scoring(model: Model, files: list[str]):
    segments, each, texts, prior = model.segments, model.each, model.train_texts, model.prior
    whole = model.train_tokens + model.distinct + 1

    def scores(rows, c, c_before, level):
        p1 = (c + 1) / whole
        pair = np.where(level > 0, 2.0 ** (np.maximum(level, 1) - 1), 0.0)
        pair = np.minimum(pair, np.minimum(c, c_before))
        p = (pair + prior * p1) / (c_before + prior)
        at = rows[:-1]
        return [
            pa.array(np.diff(rows), pa.int64()),
            pa.array(np.add.reduceat((c > 0).astype(np.int64), at), pa.int64()),
            pa.array(np.add.reduceat(np.log10(p1), at)),
            pa.array(np.add.reduceat(np.log10(p), at)),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [Shard.mapped(_local(file)) for file in files]
        numbers = np.arange(len(shards) + 1)
        for batch in bytewise(batches, "_text", TEXT_BYTES):
            tokens, before, rows = tokens_of(batch.column("_text"))
            once, place = np.unique(tokens, return_inverse=True)
            known = np.zeros(len(once), np.int64)
            for shard, at in zip(shards, _dealt(once.view(np.int64) % len(shards), numbers)):
                known[at] = shard.token_counts(once[at])
            c = known[place]
            c_before = np.empty_like(c)
            c_before[1:] = c[:-1]
            c_before[rows[:-1]] = texts
            pairs = pairs_of(before, tokens)
            level = np.zeros(len(pairs), np.int64)
            for shard, at in zip(shards, _dealt(_segment(pairs, segments), numbers * each)):
                level[at] = shard.levels(pairs[at], segments)
            names = [n for n in batch.schema.names if n != "_text"]
            arrays = [batch.column(n) for n in names] + scores(rows, c, c_before, level)
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: ``keep``, ``n_tokens``, ``n_known``, ``base_score`` (tokens alone), ``score``."""
    context = docs.sparkSession.sparkContext
    out = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    files = [_within_reach(context, model.write_shard(k)) for k in range(model.shards)]
    return out.mapInArrow(_scoring(model, files), own + SCORES)
