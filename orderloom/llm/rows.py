"""Keep or drop rows of wide tables by keys, without shuffling texts unless the keys are many."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_KEYS = 1_000_000
KEY = "_text_key"


def with_key(docs: DataFrame) -> DataFrame:
    """Add a hash of the text: with the id it tells rows apart that share an id."""
    return docs.withColumn(KEY, F.xxhash64(F.col("text").cast("string")))


def _joined(table: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """``keys`` is a written table of distinct keys; up to ``BROADCAST_KEYS`` of them (some tens of
    MB) go to the tasks that hold the wide rows, more take a shuffled join. Nulls are equal."""
    others = [c for c in keys.columns if c not in names]
    side = keys.select(*[F.col(n).alias(f"_{i}_key") for i, n in enumerate(names)], *others)
    if keys.count() <= BROADCAST_KEYS:
        side = F.broadcast(side)
    match = [table[n].eqNullSafe(side[f"_{i}_key"]) for i, n in enumerate(names)]
    return table.join(side, reduce(lambda a, b: a & b, match), how)


def only(table: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    return _joined(table, keys, names, "left_semi")


def without(table: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    return _joined(table, keys, names, "left_anti")


def attach(table: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows with a key, with the other columns of ``keys``."""
    return _joined(table, keys, names, "inner").drop(*[f"_{i}_key" for i in range(len(names))])


def attach_left(table: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """All rows, with the other columns of ``keys`` or null."""
    return _joined(table, keys, names, "left").drop(*[f"_{i}_key" for i in range(len(names))])
