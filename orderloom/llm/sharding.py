"""Shards of nearly equal bytes by sampled splitters, with DataFrame functions only.

1. A row's key is (hash of its text, hash of its id, row number), so copies of a text stand side
   by side and no two rows are alike. What is shuffled are keys and sizes, and the columns asked for.
2. Key samples are drawn with odds in proportion to size (more exactly, to size plus mean size, so
   that a huge text does not hide its small neighbours). Their quantiles by weight are splitters,
   which deal the rows to ranges; a range with more than twice the rows it should have is sampled
   and divided again, whatever made it large, as keys are never alike.
3. Running sums inside the ranges and over the ranges give every row its exact first byte in key
   order. Shards are cut at equal steps of these bytes, so they do not depend on the sample: reruns
   agree. A group of equal texts that lies across a cut goes whole to one side if it is small
   (at most the largest row, or a fiftieth of a shard), else the cut is the nearest row.

The law is ``bytes``: a shard differs from an equal share by a small group or a row at most on
either side. Each row's slot is its rank in its shard.

Defined cases: a null text has no bytes, size 1 and checksum 0, as an empty one has; null ids are
equal to each other; rows alike in text and id take neighbouring slots; with fewer rows than
shards some shards are empty; an empty table gives no rows. Columns that are not asked for are not
looked at, and those asked for may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize

KEY = ("text_hash", "id_hash", "row")
# Ranges one range is divided into at most, as bits of the range number, and sampled keys for each.
FAN_BITS, SAMPLES = 9, 24
# Rows a range may always have, and ranges or bounds (some 40 bytes each) that may be broadcast.
LEAST_ROWS, MOST_SENT = 1000, 500_000


@dataclass(frozen=True)
class Sharding:
    shards: int = 8
    # Rows of a range; less than this where that gives fewer than 2**FAN_BITS ranges.
    range_rows: int = 200_000
    # A group of equal texts of at most this part of a shard is not cut.
    whole: int = 50


def utf8(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def sized_rows(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns to keep, the text's size and checksum, the key, and the range that all rows start in."""
    text = utf8(F.col("text"))
    kept = [F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)]
    return docs.select(
        *kept,
        (F.length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.xxhash64("doc_id").alias("id_hash"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(0).cast("bigint").alias("range"),
    )


def _sent(table: DataFrame, entries: int) -> DataFrame:
    """A side to join by range: sent to all tasks as long as it is known to be small."""
    return F.broadcast(table) if entries <= MOST_SENT else table


def splitters(rows: DataFrame, parents: DataFrame, entries: int, level: int) -> DataFrame:
    """``range, bounds``: the keys that divide each parent into about ``parts`` ranges of equal bytes.

    ``parents`` has ``range, rows, bytes, parts``. A row is drawn with odds of its mass over the step
    and stands for a step, a more massive one for itself: about ``SAMPLES`` keys for a part.
    """
    parents = parents.withColumn("mean", F.col("bytes") / F.col("rows"))
    parents = parents.withColumn("step", 2 * F.col("bytes") / (F.col("parts") * SAMPLES))
    drawn = rows.join(_sent(parents.select("range", "parts", "mean", "step"), entries), "range")
    chance = F.pmod(F.xxhash64(*KEY, F.lit(level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    mass = F.col("size") + F.col("mean")
    drawn = drawn.where(chance * F.col("step") < mass).withColumn("weight", F.greatest(mass, "step"))
    in_order = Window.partitionBy("range").orderBy(*KEY)
    total = F.sum("weight").over(Window.partitionBy("range"))
    before = F.coalesce(F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    cut = drawn.withColumn("part", F.floor(before / total * F.col("parts")))
    cut = cut.withColumn("last", F.lag("part").over(in_order)).where("part > last")
    return cut.groupBy("range").agg(F.array_sort(F.collect_list(F.struct(*KEY))).alias("bounds"))


def _dealt(rows: DataFrame, bounds: DataFrame, entries: int) -> DataFrame:
    """Number the ranges anew: the old number, then how many of its bounds are at most the row's key."""
    key = F.struct(*KEY)

    def halved(found: Column, step: Column) -> Column:
        # Null beyond the last bound, which keeps what was found.
        return F.when(F.try_element_at("bounds", found + step) <= key, found + step).otherwise(found)

    steps = F.array(*[F.lit(1 << b) for b in reversed(range(FAN_BITS))])
    inner = F.coalesce(F.when(F.col("bounds").isNotNull(), F.aggregate(steps, F.lit(0), halved)), F.lit(0))
    found = rows.join(_sent(bounds, entries), "range", "left")
    return found.withColumn("range", F.col("range") * (1 << FAN_BITS) + inner).drop("bounds")


def ranged(rows: DataFrame, how: Sharding) -> tuple[DataFrame, DataFrame]:
    """``rows``, written, with ``range`` numbers in key order, and the ranges' ``rows, bytes, largest``, written.

    The driver learns how many ranges are overfull; ranges and bounds stay in written tables.
    """
    limit, level = 0, 0
    while True:
        sums = (F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("largest"))
        ranges = materialize(rows.groupBy("range").agg(*sums), "ranges")
        if not level:
            total = ranges.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            limit = max(LEAST_ROWS, min(how.range_rows, total >> FAN_BITS))
        parts = F.least(F.lit(1 << FAN_BITS), F.ceil(F.col("rows") / limit)).cast("int").alias("parts")
        overfull = ranges.where(F.col("rows") > 2 * limit).select("range", "rows", "bytes", parts)
        entries = overfull.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
        if not entries:
            return rows, ranges
        level += 1
        bounds = materialize(splitters(rows, overfull, entries, level), "splitters")
        rows = materialize(_dealt(rows, bounds, entries), "ranged")


def _placed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each row's ``first_byte`` and ``rank`` in the order of keys."""
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "range",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    by_key = Window.partitionBy("range").orderBy(*KEY)
    inside = F.coalesce(F.sum("size").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.withColumns({"inside": inside, "nth": F.row_number().over(by_key) - 1})
    return numbered.join(_sent(starts, ranges.count()), "range").select(
        *[c for c in rows.columns if c != "range"],
        (F.col("bytes_before") + F.col("inside")).alias("first_byte"),
        (F.col("rows_before") + F.col("nth")).alias("rank"),
    )


def _nearer(cut: int, low: int, high: int) -> int:
    return low if cut - low <= high - cut else high


def cuts(placed: DataFrame, total: int, largest: int, how: Sharding) -> list[int]:
    """The first byte of every shard but the first, moved to the edge of a row or a small group."""
    wanted = [total * k // how.shards for k in range(1, how.shards)]
    end = F.col("first_byte") + F.col("size")
    crossed = F.lit(False)
    for cut in wanted:
        crossed = crossed | ((F.col("first_byte") <= cut) & (end > cut))
    rows = placed.where(crossed).select("text_hash", "first_byte", end.alias("end")).collect()
    own = F.col("text_hash").isin([row.text_hash for row in rows])
    extents = placed.where(own).groupBy("text_hash").agg(F.min("first_byte").alias("low"), F.max(end).alias("high"))
    groups = {group.text_hash: group for group in extents.collect()}
    small = max(largest, total // (how.shards * how.whole))
    moved = []
    for cut in wanted:
        row = next(r for r in rows if r.first_byte <= cut < r.end)
        group = groups[row.text_hash]
        low, high = (group.low, group.high) if group.high - group.low <= small else (row.first_byte, row.end)
        moved.append(low if cut - low <= high - cut else high)
    return moved


def _sharded(docs: DataFrame, keep: Sequence[str], how: Sharding) -> DataFrame:
    """``_keep_0, _keep_1, ...`` for the columns to keep, ``size, text_crc32, shard, slot``."""
    rows, ranges = ranged(materialize(sized_rows(docs, keep), "sized"), how)
    placed = materialize(_placed(rows, ranges), "placed")
    totals = ranges.agg(F.sum("bytes"), F.max("largest")).first()
    shard = F.lit(0)
    for cut in cuts(placed, *totals, how) if totals[0] else ():
        shard = shard + (F.col("first_byte") >= cut).cast("int")
    dealt = placed.withColumn("shard", shard)
    firsts = {row.shard: row.first for row in dealt.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    first = F.array(*[F.lit(firsts.get(number, 0)).cast("bigint") for number in range(how.shards)])
    return dealt.withColumn("slot", F.col("rank") - first[F.col("shard")]).select(
        *[f"_keep_{i}" for i in range(len(keep))], "size", "text_crc32", "shard", "slot"
    )


def shard(docs: DataFrame, keep: Sequence[str] = ("doc_id",), how: Sharding = Sharding()) -> DataFrame:
    """Every row of ``docs`` (columns ``doc_id, text``): ``keep``, then ``size, text_crc32, shard, slot``."""
    return _sharded(docs, keep, how).toDF(*keep, "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, folder: str, how: Sharding = Sharding()) -> DataFrame:
    """Write the whole rows, a folder ``_shard=N`` for each shard, with their ``_slot``; returns what was written."""
    sharded = _sharded(docs, docs.columns, how).drop("size", "text_crc32")
    sharded.toDF(*docs.columns, "_shard", "_slot").write.partitionBy("_shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder)
