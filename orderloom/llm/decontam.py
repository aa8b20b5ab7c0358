"""Benchmark decontamination as a prefix-filtered join of word windows.

A benchmark item becomes windows of ten consecutive words; a shorter item is
one window. A window occurs in a document only if all of its shingles (pairs of
neighbouring words, or the word itself in a one-word window) occur there. For
full containment a prefix of one shingle is necessary: windows are therefore
found by their rarest shingle, rarity being counted over all documents.

Where that shingle stands in the document fixes where the window would have to
begin (positional bound), the document must be long enough on both sides
(length bound), and what is left is compared word by word.

The first pass over the documents counts the shingles of the benchmark, the
second finds and verifies windows. What each task needs of the benchmark is its
vocabulary, shingle table and windows; blocks of ``block_windows`` windows keep
that bounded, however many items there are, and each block takes its own pass.

Defined cases: a null or empty text has no words; an item without words has no
windows; a null item id counts as the empty string; repeated items count once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.words import bytewise, combine, split_words
from orderloom.operators.storage import materialize

WINDOW = 10
# Some 130 bytes each in a task, and 1,200 on the driver while it ranks their shingles.
BLOCK_WINDOWS = 250_000
# Words are letters and digits, and everything beyond ASCII; A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows with the items they belong to: ``words`` array, ``items`` array of strings."""
    words = F.regexp_extract_all(F.translate(F.col("text").cast("string"), _UPPER, _LOWER), F.lit(WORD), 0)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words"))
    items = items.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    windows = items.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start"), width).alias("words")
    )
    return windows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


@dataclass
class Block:
    """A bounded set of windows in the form that tasks use. Word 0 is any word outside the benchmark."""

    vocabulary: np.ndarray  # sorted word hashes; the word's number is its place + 1
    words: np.ndarray  # numbers, -1 beyond the end, one line per window
    lengths: np.ndarray
    items: pa.ListArray  # of strings, a list per window
    key: np.ndarray | None = None  # sorted rarest shingle of each window
    at: np.ndarray | None = None  # the window it belongs to
    offset: np.ndarray | None = None  # and where in the window it stands

    @classmethod
    def of(cls, windows: pa.Table) -> Block:
        listed, items = (windows.column(name).combine_chunks() for name in ("words", "items"))
        hashes = split_words(listed.flatten().cast(pa.large_string()), alnum=True).hashes
        vocabulary, number = np.unique(hashes, return_inverse=True)
        lengths = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        words = np.full((len(lengths), int(lengths.max(initial=1))), -1, np.int64)
        words[np.arange(words.shape[1]) < lengths[:, None]] = number + 1
        return cls(vocabulary, words, lengths, items)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)

    def pairs(self, numbers: np.ndarray, following: np.ndarray) -> np.ndarray:
        """A shingle of two benchmark words; 0 if one is unknown."""
        size = len(self.vocabulary) + 1
        return np.where((numbers > 0) & (following > 0), numbers * size + following, 0)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """The shingle at each offset of each window (0 beyond its end), and which exist."""
        following = np.full_like(self.words, -1)
        following[:, :-1] = self.words[:, 1:]
        pairs = self.pairs(np.maximum(self.words, 0), np.maximum(following, 0))
        single = self.lengths == 1
        pairs[single, 0] = -self.words[single, 0]  # one-word windows have the word, as a negative number
        return pairs, pairs != 0

    def index(self, known: np.ndarray, often: np.ndarray) -> None:
        """Choose each window's rarest shingle, of equal ones the smallest, then the first.

        ``often`` is how often the shingles ``known`` (sorted) stand in the documents."""
        pairs, real = self.shingles()
        count = np.zeros(pairs.shape, np.int64)
        if len(known):
            place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            count = np.where(known[place] == pairs, often[place], 0)
        rank = np.lexsort((pairs.ravel(), np.where(real, count, np.iinfo(np.int64).max).ravel()))
        order = np.empty(pairs.size, np.int64)
        order[rank] = np.arange(pairs.size)
        offset = order.reshape(pairs.shape).argmin(1)
        key = pairs[np.arange(len(pairs)), offset]
        sort = np.argsort(key, kind="stable")
        self.key, self.at, self.offset = key[sort], sort, offset[sort]


def _batch_shingles(block: Block, column: pa.Array):
    """Word numbers of a batch, its row bounds, and two shingle columns: pairs and single words."""
    found = split_words(column, alnum=True)
    numbers = block.numbers(found.hashes)
    row_of = found.row_of()
    pairs = np.zeros(len(numbers), np.int64)
    if len(numbers) > 1:
        pairs[:-1] = block.pairs(numbers[:-1], numbers[1:])
        pairs[:-1][row_of[:-1] != row_of[1:]] = 0
    return numbers, found.rows, row_of, pairs, -numbers


def _counting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in bytewise(batches, "_text"):
            _, _, _, pairs, singles = _batch_shingles(block, batch.column("_text"))
            for found in (pairs, singles):
                found = found[found != 0]
                place = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                total += np.bincount(place[wanted[place] == found], minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen]), pa.array(total[seen])], names=["shingle", "n"])

    return run


def _shingle_counts(spark: SparkSession, texts: DataFrame, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the block that stand in documents, sorted, and how often; two numbers a shingle."""
    pairs, real = block.shingles()
    wanted = np.unique(pairs[real])
    if not len(wanted):
        return wanted, wanted
    shared = spark.sparkContext.broadcast((block, wanted))
    counted = texts.mapInArrow(_counting(shared), "shingle bigint, n bigint")
    found = counted.groupBy("shingle").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    known, often = found.column("shingle").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(known)
    return known[order], often[order]


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] of them, for all i in one column."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - first, count)


def _find(block: Block, numbers, rows, row_of, shingles) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified occurrences as (first word, window), a bounded number of candidates at a time."""
    at = np.flatnonzero(shingles)
    left = np.searchsorted(block.key, shingles[at])
    count = np.searchsorted(block.key, shingles[at], side="right") - left
    at, left, count = at[count > 0], left[count > 0], count[count > 0]
    part = np.cumsum(count) // 200_000
    for k in np.unique(part):
        own = part == k
        entry = _expand(left[own], count[own])
        word = np.repeat(at[own], count[own])
        window, begin = block.at[entry], word - block.offset[entry]
        row = row_of[word]
        fits = (begin >= rows[row]) & (begin + block.lengths[window] <= rows[row + 1])
        begin, window = begin[fits], window[fits]
        equal = np.ones(len(begin), bool)
        for j in range(block.words.shape[1]):
            expected = block.words[window, j]
            inside = expected >= 0
            equal &= ~inside | (numbers[np.where(inside, begin + j, 0)] == expected)
        yield begin[equal], window[equal]


_TEXT_TYPE = "_text string, "
_FOUND = ("n_words", "spans", "items")
_FOUND_TYPES = "n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"


def _finding(shared, keep_text: bool):
    """Adds what one block finds to what earlier blocks found, if their columns are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in bytewise(batches, "_text"):
            numbers, rows, row_of, pairs, singles = _batch_shingles(block, batch.column("_text"))
            change = np.zeros(len(numbers) + 1, np.int64)
            items: list[set[str]] = [set() for _ in range(len(rows) - 1)]
            if "spans" in batch.schema.names:
                _add_earlier(batch, rows, change, items)
            for shingles in (pairs, singles):
                for begin, window in _find(block, numbers, rows, row_of, shingles):
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + block.lengths[window], -1)
                    for row, w in set(zip(row_of[begin].tolist(), window.tolist())):
                        items[row].update(block.items[w].as_py())
            hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            own = np.searchsorted(hit, rows)
            spans = [_spans(hit[a:b] - first) for a, b, first in zip(own, own[1:], rows)]
            names = [n for n in batch.schema.names if n not in _FOUND and (keep_text or n != "_text")]
            arrays = [batch.column(n) for n in names] + [
                pa.array(np.diff(rows), pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *_FOUND])

    return run


def _add_earlier(batch: pa.RecordBatch, rows: np.ndarray, change: np.ndarray, items: list[set[str]]) -> None:
    earlier = zip(rows.tolist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist())
    for i, (first, spans, ids) in enumerate(earlier):
        for span in spans:
            change[first + span["first"]] += 1
            change[first + span["last"] + 1] -= 1
        items[i].update(ids)


def _spans(hit: np.ndarray) -> list[dict]:
    """Runs of neighbouring word numbers."""
    if not len(hit):
        return []
    breaks = np.flatnonzero(np.diff(hit) > 1)
    firsts, lasts = hit[np.r_[0, breaks + 1]], hit[np.r_[breaks, len(hit) - 1]]
    return [{"first": int(a), "last": int(b)} for a, b in zip(firsts, lasts)]


def _blocks(windows: DataFrame, block_windows: int) -> Iterator[pa.Table]:
    """The windows in tables of at most ``block_windows`` rows, so the driver holds one at a time."""
    total = windows.count()
    n = max(1, -(-total // block_windows))
    if n == 1:
        yield windows.toArrow()
        return
    for k in range(2 * n):  # half-full on average, so that none exceeds the bound by chance
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(2 * n)) == k).toArrow()
        for a in range(0, len(part), block_windows):
            yield part.slice(a, block_windows)


def find_items(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), width: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, ``n_words``, ``spans`` of hit words (0-based, both
    ends included, in order) and the ids of ``items`` with a window in the text, sorted."""
    spark = docs.sparkSession
    windows = materialize(item_windows(benchmark, width), "windows")
    found = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema) + _TEXT_TYPE
    blocks = _blocks(windows, block_windows)
    rows, number = next(blocks), 0
    while rows is not None:
        following = next(blocks, None)
        block = Block.of(rows)
        block.index(*_shingle_counts(spark, found.select("_text"), block))
        finding = _finding(spark.sparkContext.broadcast(block), keep_text=following is not None)
        if following is None:
            return found.mapInArrow(finding, own.removesuffix(_TEXT_TYPE) + _FOUND_TYPES)
        found = materialize(found.mapInArrow(finding, own + _FOUND_TYPES), f"block-{number}")
        rows, number = following, number + 1


def hit_words(spans: Column) -> Column:
    """How many words the spans hold."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
