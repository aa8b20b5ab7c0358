"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1. Documents with the same shingle set form a class; its smallest document stands
   for it, so thousands of copies cost one row from here on.
2. Signatures of classes are cut into bands; classes that agree on a band share a
   bucket. Each class is compared with the first class of its buckets.
3. A comparison looks at the signatures batch by batch and gives up as soon as
   the posterior probability of reaching the similarity falls below ``miss``.
4. Survivors are verified on the full shingle sets, computed again from the texts.
5. Buckets whose classes are not all connected by then are compared completely, by
   steps 3 and 4, in blocks of bounded size inside tasks. Classes already connected
   are left out, and only links that connect something are returned: none is lost to
   the choice of the first class, and a large group's pairs are never written out.
6. The links of steps 4 and 5 give the components.

Defined cases: a null or empty text has no shingles and no links; with fewer
words than a shingle the whole sequence is the one shingle; repeated rows belong
to one class; rows with one id and different texts are one node with the links
of all of them; rows without an id link with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import components
from orderloom.llm.rows import only
from orderloom.llm.words import Words, bytewise, combine, mix, split_words
from orderloom.operators.storage import materialize

BLOCK = 256


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; similar from ``percent`` / 100 on. With 32 bands of 6 rows a
    pair at 0.8 shares a bucket with odds of 0.9999, and ``miss`` bounds what pruning loses."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 6
    batch: int = 32
    miss: float = 1e-6

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """(signature places seen, matches needed to go on) after each batch.

        With a uniform prior, k matches of m give a Beta(k + 1, m - k + 1) posterior, whose mass
        from t on equals the probability of at most k successes in m + 1 trials at t.
        """
        t = self.percent / 100
        out = []
        for m in [*range(self.batch, self.size, self.batch), self.size]:
            mass, k = 0.0, -1
            while mass < self.miss:
                k += 1
                mass += comb(m + 1, k) * t**k * (1 - t) ** (m + 1 - k)
            out.append((m, k))
        return out


def _shingles(words: Words, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingle hashes; shorter texts have one for all their words."""
    h, rows = words.hashes, words.rows
    windows = combine(*[h[k : len(h) - n + 1 + k] for k in range(n)]) if len(h) >= n else h[:0]
    for a, b in zip(rows.tolist(), rows[1:].tolist()):
        if b - a >= n:
            yield np.unique(windows[a : b - n + 1])
        elif b > a:
            yield combine(*[h[k : k + 1] for k in range(a, b)], np.array([b - a], np.uint64))
        else:
            yield h[:0]


def _signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 512):
        part = shingles[a : a + 512, None] * factors
        part += shifts
        np.minimum(out, part.min(0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _hash_family(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919)
    draw = rng.integers(0, 1 << 63, (2, size), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1] * np.uint64(2)


def _signing(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _hash_family(settings.size)
        for batch in bytewise(batches, "_text"):
            sizes, sets, signatures = [], [], []
            for found in _shingles(split_words(batch.column("_text")), settings.words):
                sizes.append(len(found))
                sets.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(_signature(found, factors, shifts).tobytes() if len(found) else None)
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "set_id", "signature"]
            )

    return run


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_id`` (a digest of the shingle set, null if empty) and ``signature``."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(_signing(settings), f"doc_id {kind}, n_shingles bigint, set_id binary, signature binary")


def _banding(settings: Settings):
    """One row per band: the bucket's key, a hash of the band's number and its signature places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            places = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32)
            places = places.reshape(n, settings.bands, settings.rows).astype(np.uint64)
            key = np.tile(np.arange(settings.bands, dtype=np.uint64), (n, 1))
            for r in range(settings.rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + places[:, :, r])
            doc = batch.column("doc_id").take(pa.array(np.repeat(np.arange(n), settings.bands)))
            band = pa.array(np.tile(np.arange(settings.bands, dtype=np.int32), n))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), band, doc], names=["bucket", "band", "doc_id"])

    return run


def _matches_enough(left: np.ndarray, right: np.ndarray, steps) -> np.ndarray:
    """The pairs of signature lines that no batch prunes."""
    at, seen, matches = np.arange(len(left)), 0, np.zeros(len(left), np.int64)
    for m, least in steps:
        matches += (left[at, seen:m] == right[at, seen:m]).sum(1)
        stays = matches >= least
        at, matches, seen = at[stays], matches[stays], m
    return at


def _lines(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), size)


def _pruning(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = settings.least_matches()
        for batch in batches:
            left, right = (_lines(batch.column(n), settings.size) for n in ("sig_a", "sig_b"))
            at = pa.array(_matches_enough(left, right, steps))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return run


def _verifying(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bytewise(list(bytewise([whole], "text_a")), "text_b"):
                left = _shingles(split_words(batch.column("text_a")), settings.words)
                right = _shingles(split_words(batch.column("text_b")), settings.words)
                linked = [i for i, (x, y) in enumerate(zip(left, right)) if _similar(x, y, settings.percent)]
                at = pa.array(linked, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return run


def _sides(pairs: DataFrame, table: DataFrame, value: str, name: str) -> DataFrame:
    """Attach ``value`` of both documents of a pair."""
    for side in ("a", "b"):
        own = table.select(F.col("doc_id").alias(side), F.col(value).alias(f"{name}_{side}"))
        pairs = pairs.join(own, side)
    return pairs


def _first_shared(left: np.ndarray, right: np.ndarray, settings: Settings) -> np.ndarray:
    """The first band on which signature lines agree."""
    same = (left == right).reshape(-1, settings.bands, settings.rows).all(2)
    return same.argmax(1)


class _Sets:
    """Shingle sets of a group's texts, each computed when it is first asked for."""

    def __init__(self, texts: list[str], words: int):
        self.texts, self.words, self.held = texts, words, {}

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.held:
            text = pa.array([self.texts[i]], pa.large_string())
            self.held[i] = next(_shingles(split_words(text), self.words))
        return self.held[i]


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _group_links(rows: list[tuple], band: int, settings: Settings, steps) -> list[tuple[int, int]]:
    """Links within one group of a bucket that connect classes not connected before.

    Every pair is looked at in the first bucket that it shares, by signatures, and verified on
    the sets unless the links found so far connect it already.
    """
    number = {root: k for k, root in enumerate({r[1]: None for r in rows})}
    home = np.array([number[r[1]] for r in rows])
    block = np.array([r[2] for r in rows])
    across = block.min() != block.max()
    lines = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), settings.size)
    sets = _Sets([r[4] for r in rows], settings.words)
    found = []
    for i in range(len(rows) - 1):
        other = np.flatnonzero(home[i + 1 :] != home[i]) + i + 1
        if across:
            other = other[block[other] != block[i]]
        other = other[_matches_enough(np.broadcast_to(lines[i], (len(other), settings.size)), lines[other], steps)]
        other = other[_first_shared(lines[i], lines[other], settings) == band] if len(other) else other
        for j in other.tolist():
            if home[i] != home[j] and _similar(sets[i], sets[j], settings.percent):
                found.append((rows[i][0], rows[j][0]))
                home[home == home[j]] = home[i]
    return found


def _comparing(settings: Settings):
    columns = ("bucket", "band", "kind", "low", "high", "doc_id", "root", "block", "signature", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, kinds = settings.least_matches(), []

        def rows():
            for batch in batches:
                kinds[:] = [batch.column("doc_id").type]
                for part in bytewise([batch], "text", 8 << 20):
                    yield from zip(*(part.column(n).to_pylist() for n in columns))

        for key, members in groupby(rows(), key=lambda r: r[:5]):
            if found := _group_links([r[5:] for r in members], key[1], settings, steps):
                yield pa.RecordBatch.from_arrays([pa.array(x, kinds[0]) for x in zip(*found)], names=["a", "b"])

    return run


def _block_pairs(members: DataFrame) -> DataFrame:
    """Deal the members of buckets to groups of bounded size that together hold all pairs of interest.

    A bucket's largest component is dealt to inner blocks, the other classes to outer blocks.
    Every inner block meets every outer block (``kind`` 0), and the outer blocks meet each other
    (``kind`` 1); the classes of the largest component need no comparison with each other.
    ``block`` tells sides apart. Classes are dealt by a hash, 3/4 of ``BLOCK`` to a block on
    average, which leaves a group of two blocks 6 standard deviations below 2 * ``BLOCK`` rows.
    """
    key = ["bucket", "band"]
    parts = members.groupBy(*key, "root").agg(F.count("*").alias("n"))
    tops = parts.groupBy(*key).agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
    tops = tops.select(*key, F.col("top.root").alias("top"), F.col("top.n").alias("inside"), "all")

    def blocks(n: Column) -> Column:
        return F.when(n <= BLOCK, 1).otherwise(F.ceil(n / (0.75 * BLOCK))).cast("int")

    def place(n: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id"), n).cast("int")

    def to(kind: int, low: Column, high: Column, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), block.alias("block"))

    inner, outer = blocks(F.col("inside")), blocks(F.col("all") - F.col("inside"))
    own, mine = place(inner), place(outer)
    hosts = F.transform(F.sequence(F.lit(0), outer - 1), lambda j: to(0, own, j, F.lit(0)))
    visits = F.transform(F.sequence(F.lit(0), inner - 1), lambda j: to(0, j, mine, F.lit(1)))
    pairs = F.transform(F.sequence(F.lit(0), outer - 1), lambda j: to(1, F.least(mine, j), F.greatest(mine, j), mine))
    groups = F.when(F.col("root") == F.col("top"), hosts).otherwise(F.concat(visits, pairs))
    dealt = members.join(tops, key).select(*key, "doc_id", "root", F.explode(groups).alias("group"))
    return dealt.select(*key, "doc_id", "root", "group.*")


def _ids(pairs: DataFrame) -> DataFrame:
    both = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id")))
    return materialize(both.distinct(), "ids")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return only(texts, ids, ["doc_id"])


def _verified(pairs: DataFrame, docs: DataFrame, settings: Settings, kind: str) -> DataFrame:
    """The pairs (a written table) that are similar by their full shingle sets."""
    needed = materialize(_texts(docs, _ids(pairs)), "texts")
    linked = _sides(pairs, needed, "text", "text").mapInArrow(_verifying(settings), f"a {kind}, b {kind}")
    return materialize(linked, "links")


def links(docs: DataFrame, signed: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Classes (``set_id``, ``representative``) and links between representatives.

    The links connect what a full comparison of all buckets would connect.
    """
    kind = dict(docs.dtypes)["doc_id"]
    real = signed.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(real.groupBy("set_id").agg(F.min("doc_id").alias("representative")), "classes")
    keys = classes.select("set_id", F.col("representative").alias("doc_id"))
    firsts = only(real, keys, ["set_id", "doc_id"])
    firsts = firsts.select("doc_id", "signature")
    buckets = firsts.mapInArrow(_banding(settings), f"bucket bigint, band int, doc_id {kind}")
    sizes = buckets.groupBy("bucket", "band").agg(F.count("*").alias("members"), F.min("doc_id").alias("first"))
    shared = materialize(buckets.join(sizes.where("members > 1"), ["bucket", "band"]), "buckets")

    pairs = shared.where("doc_id != first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    pairs = materialize(pairs.distinct(), "pairs")
    lines = materialize(only(firsts, _ids(pairs), ["doc_id"]), "lines")
    pruned = _sides(pairs, lines, "signature", "sig").mapInArrow(_pruning(settings), f"a {kind}, b {kind}")
    found = _verified(materialize(pruned, "pruned"), docs, settings, kind)

    roots = materialize(components(found), "first-roots")
    rooted = shared.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "doc_id")), "rooted")
    ends = rooted.groupBy("bucket", "band").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    mixed = rooted.join(ends.where("least != most"), ["bucket", "band"], "left_semi")
    mixed = materialize(mixed, "mixed")
    ids = materialize(mixed.select("doc_id").distinct(), "ids")
    members = _texts(docs, ids).join(only(lines, ids, ["doc_id"]), "doc_id")
    work = _block_pairs(mixed).join(members, "doc_id")
    key = ["bucket", "band", "kind", "low", "high"]
    work = work.select(*key, "doc_id", "root", "block", "signature", "text")
    more = work.repartition(*key).sortWithinPartitions(*key).mapInArrow(_comparing(settings), f"a {kind}, b {kind}")
    extra = materialize(more, "more-links")
    stars = roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return classes, stars.unionByName(extra)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``; a component's smallest id is kept."""
    signed = materialize(signatures(docs, settings), "signed")
    classes, found = links(docs, signed, settings)
    roots = components(found).withColumnRenamed("node", "representative")
    home = classes.join(roots, "representative", "left").select("set_id", F.coalesce("root", "representative").alias("home"))
    # A row without an id links with nothing, though its text may be that of others.
    linked = F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id")
    rows = signed.select("doc_id", "n_shingles", linked).join(home, "set_id", "left")
    component = F.coalesce("home", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
