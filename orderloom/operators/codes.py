"""Cross-row facts about order codes: repeated in the feed, stored already."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize
from orderloom.operators.timeline import count_rows, fit_tasks


def first_positions(orders: DataFrame) -> DataFrame:
    """One row per code with the position of its first row (map-side combined)."""
    return orders.groupBy("order_code").agg(F.min("pos").alias("first_pos"))


def mark_stored(facts: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``stored`` (true or null) to one row per code.

    The registry is cut to the codes in question before anything else, so a few
    codes reach a large registry as a broadcast and nothing of it is shuffled.
    """
    return facts.join(_known(facts, registry), "order_code", "left")


def _known(asked: DataFrame, registry: DataFrame) -> DataFrame:
    known = already_stored(registry.select("order_code"), asked).distinct()
    return known.withColumn("stored", F.lit(True))


def flag_codes(orders: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Add ``repeated`` (an earlier row has the code) and ``stored`` (the registry has it).

    Only the first row of a code can carry ``stored``: on a later row
    ``repeated`` fires first. So the registry meets one row per distinct code,
    and the facts come back by (code, position), which is unique per row: no
    code, however frequent, makes a large partition. A blank code never repeats.
    """
    # The filter keeps the position on both sides that need these rows, so that they are shuffled once
    # (a row without a position is no first row anyway).
    firsts = first_positions(orders).where(F.col("first_pos").isNotNull())
    if registry is None:
        facts = firsts.withColumn("stored", F.lit(False))
    else:
        facts = mark_stored(firsts, registry)
    facts = facts.withColumnRenamed("first_pos", "pos").withColumn("is_first", F.lit(True))
    return orders.join(facts, ["order_code", "pos"], "left").withColumns(
        {
            "repeated": (F.col("order_code") != "") & F.col("is_first").isNull(),
            "stored": F.coalesce("stored", F.lit(False)),
        }
    ).drop("is_first")


def flag_stored_firsts(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``stored`` as ``flag_codes`` does, where ``pos`` may be several columns.

    Such positions are no hash aggregate's value, so their minimum would sort all rows before they
    are shuffled and after. As long as no code has more rows than one task should take, one window
    ranks them instead, and the registry meets the counted codes, which are written.
    """
    counts = materialize(count_rows(requests, "order_code"), "asked")
    if not fit_tasks(counts):
        return flag_codes(requests, registry).drop("repeated")
    place = F.rank().over(Window.partitionBy("order_code").orderBy(F.col("pos").asc_nulls_last()))
    ranked = requests.withColumn("is_first", (place == 1) & F.col("pos").isNotNull())
    stored = F.coalesce(F.col("is_first") & F.col("stored"), F.lit(False))
    known = _known(counts, registry)
    return ranked.join(known, "order_code", "left").withColumn("stored", stored).drop("is_first")


def flag_codes_on_every_row(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """As ``flag_codes``, with ``stored`` on every row of a stored code, repeated or not."""
    facts = mark_stored(first_positions(orders), registry)
    return orders.join(facts, "order_code", "left").withColumns(
        {
            "repeated": F.col("pos") > F.col("first_pos"),
            "stored": F.coalesce("stored", F.lit(False)),
        }
    ).drop("first_pos")


def first_rows(orders: DataFrame) -> DataFrame:
    """The first row of every code, whole."""
    firsts = first_positions(orders).withColumnRenamed("first_pos", "pos")
    return orders.join(firsts, ["order_code", "pos"], "left_semi")


def already_stored(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose code the registry has."""
    return orders.join(registry.select("order_code"), "order_code", "left_semi")


def not_stored(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows, at most one per code, whose code the registry lacks."""
    return orders.join(registry.select("order_code"), "order_code", "left_anti")
