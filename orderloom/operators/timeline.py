"""Per-key sequences: "the last value before this row" and "the position of this row".

As long as no key has more rows than one task should take, plain windows do. Else
rows are range-partitioned by (key, order) and written once; each partition is
a chunk. Windows run per (key, chunk), so a key with any share of the rows is
spread over as many tasks as its rows need, and only a key that goes on from
one chunk to the next needs what came before. Those keys are among the first
and last keys of the chunks: at most two per chunk, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize


# Rows of one key that a task may take.
TASK_ROWS = 1_000_000


def count_rows(df: DataFrame, key: str) -> DataFrame:
    """Each key with its number of ``rows`` (map-side combined)."""
    return df.groupBy(key).agg(F.count("*").alias("rows"))


def fit_tasks(counts: DataFrame) -> bool:
    """Whether no key has more rows than one task should take."""
    return (counts.agg(F.max("rows")).first()[0] or 0) <= TASK_ROWS


class Timeline:
    """Rows of a table in a unique order per key, open for sequence columns.

    ``counts`` may be given: the number of ``rows`` of each key (``count_rows``).
    """

    def __init__(self, df: DataFrame, key: str, order: Sequence[str], counts: DataFrame | None = None):
        self.key, self.order = key, list(order)
        if fit_tasks(count_rows(df, key) if counts is None else counts):
            self._rows, self._edges = df.withColumn("_chunk", F.lit(0)), None
            return
        ranged = df.repartitionByRange(key, *self.order)
        # Range bounds come from a sample: what follows must see one choice of them.
        self._rows = materialize(ranged.withColumn("_chunk", F.spark_partition_id()), "chunks")
        self._edges = self._edge_keys(self._rows)

    def _edge_keys(self, rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("_chunk").agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))
        return ends.select(F.explode(F.array("low", "high")).alias(self.key)).distinct()

    def _with(self, rows: DataFrame) -> Timeline:
        changed = copy(self)
        changed._rows = rows
        return changed

    def _window(self) -> WindowSpec:
        return Window.partitionBy(self.key, "_chunk").orderBy(*self.order)

    def _carried(self, chunk_value: Column, over_earlier: Column) -> DataFrame:
        """What each chunk of an edge key receives from the chunks before it."""
        edge = self._rows.join(F.broadcast(self._edges), self.key, "left_semi")
        ends = edge.groupBy(self.key, "_chunk").agg(chunk_value.alias("_end"))
        earlier = (
            Window.partitionBy(self.key)
            .orderBy("_chunk")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return ends.select(self.key, "_chunk", over_earlier.over(earlier).alias("_carry"))

    def _attach(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(carry), [self.key, "_chunk"], "left")

    def derive(self, columns: dict[str, Column]) -> Timeline:
        """Add columns computed from the row itself."""
        return self._with(self._rows.withColumns(columns))

    def last_before(self, value: Column, name: str) -> Timeline:
        """Add the last non-null ``value`` among earlier rows of the same key."""
        earlier = self._window().rowsBetween(Window.unboundedPreceding, -1)
        rows = self._rows.withColumn(name, F.last(value, ignorenulls=True).over(earlier))
        if self._edges is None:
            return self._with(rows)
        moment = F.when(value.isNotNull(), F.struct(*self.order))
        carry = self._carried(F.max_by(value, moment), F.last("_end", ignorenulls=True))
        rows = self._attach(rows, carry).withColumn(name, F.coalesce(name, "_carry"))
        return self._with(rows.drop("_carry"))

    def position(self, name: str) -> Timeline:
        """Add the 1-based position of the row among the rows of its key."""
        rows = self._rows.withColumn(name, F.row_number().over(self._window()).cast("bigint"))
        if self._edges is None:
            return self._with(rows)
        carry = self._carried(F.count("*"), F.sum("_end"))
        offset = F.coalesce("_carry", F.lit(0))
        rows = self._attach(rows, carry).withColumn(name, F.col(name) + offset)
        return self._with(rows.drop("_carry"))

    def rows(self) -> DataFrame:
        return self._rows.drop("_chunk")
