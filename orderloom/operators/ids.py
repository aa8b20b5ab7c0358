"""Dense ids and ranks without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize

_ROW_MASK = (1 << 33) - 1


def dense_ids(
    df: DataFrame, order: Sequence[Column | str], name: str = "id", after: int | Column = 0
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in ``order``, which must be unique per row.

    Rows are range-partitioned and sorted, so one huge sort key spreads over
    many tasks as long as later order columns differ. Partition number and row
    number inside it are written to the shared folder: range bounds come from a
    sample, so later passes must read the same partitions. What remains is one
    offset per partition, as many rows as there were partitions.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialize(
        spread.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id().bitwiseAND(_ROW_MASK),
            }
        ),
        name,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    start = after if isinstance(after, Column) else F.lit(after)
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, (start + F.col("_offset") + F.col("_row") + 1).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )
