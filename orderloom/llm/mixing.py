"""Mix sources to target weights by a low-discrepancy schedule, with DataFrame functions only.

1. Every source gets a target by its weight; a target stops at ``most`` times the
   source's size, and what is left over goes to the others by weight.
2. The schedule has one slot per block of ``block`` words. Slot n lies at the
   n-th point of the golden-ratio sequence; the sources' needs, laid end to end,
   divide the line, so each stretch of the schedule holds each source close to
   its share. A source's slots are ranked; a slot too many is left out, the few
   that chance withholds follow at the end.
3. A source's documents stand in an order given by a hash of their id, repeated
   as often as needed, and are cut into blocks of equal words up to the target.
   Slot r of a source takes its block r.

Running sums over a source go by two levels of hash digits, so a source with a
third of all documents is as spread out as any. What grows with the number of
sources only (one row each) is ordered in one window.

Defined cases: a null text has no words and nothing of it is taken; a null source
is a source of its own, after all others; a null id is replaced by a hash of the text;
repeated rows are placed one after the other. Without words all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.words import SPACE_CLASS
from orderloom.operators.storage import materialize

# The golden ratio times 2**32; its multiples modulo 2**32 are the sequence's points.
GOLDEN = 2654435769
LINE_BITS, CELL_BITS, CHUNK = 32, 20, 2048


@dataclass(frozen=True)
class Mix:
    weights: Sequence[int] = (3, 1, 2)  # by the sources' order, again and again
    percent: int = 150  # of all words
    most: int = 2  # times a source's own size
    block: int = 2048
    seed: str = "mix"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    marked = F.regexp_replace(text.cast("string"), "[^\\x20\\x09-\\x0D]+", "x")
    return F.coalesce(F.length(F.regexp_replace(marked, SPACE_CLASS + "+", "")), F.lit(0)).cast("bigint")


def _sized(docs: DataFrame, keep: Sequence[str], mix: Mix) -> DataFrame:
    source = F.col("source").cast("string")
    # Rows without an id are told apart by their text, so that many of them do not share one place.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("text").cast("binary"))), F.lit(""))
    order = F.md5(F.concat(F.lit(f"{mix.seed}:"), name).cast("binary"))
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    return docs.select(
        *kept,
        F.coalesce(F.concat(F.lit("s"), source), F.lit("t")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        order.alias("place"),
    ).withColumns({"d1": F.substring("place", 1, 2), "d2": F.substring("place", 3, 3)})


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: ``source_key, source_size, target, budget`` (whole words), ``need`` (blocks).

    ``sizes`` has ``source_key`` and ``size``. With sources in the order of cap by weight, the level
    at which weights share what earlier caps leave rises up to the first source below its cap and
    falls after it: its maximum is the level of all sources that stay below their caps.
    """
    weights = F.array(*map(F.lit, mix.weights))
    by_name = Window.orderBy("source_key")
    rank = F.row_number().over(by_name) - 1
    totals = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    weighed = totals.withColumn("weight", F.element_at(weights, F.pmod(rank, F.lit(len(mix.weights))) + 1))
    weighed = weighed.withColumn("cap", F.col("source_size") * mix.most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    everything = F.sum("source_size").over(Window.partitionBy())
    capped = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (everything * mix.percent - capped * 100) / (rest * 100)
    leveled = weighed.withColumn("level", level)
    target = F.least(F.col("cap").cast("double"), F.max("level").over(Window.partitionBy()) * F.col("weight"))
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    need = F.ceil(F.col("budget") / mix.block).cast("bigint")
    chosen = leveled.withColumn("target", target).withColumn("budget", budget).withColumn("need", need)
    return chosen.select("source_key", "source_size", "target", "budget", "need")


def schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``slot, source_key, rank``: which block of which source each slot takes. ``sources`` is written."""
    slots = sources.agg(F.sum("need")).first()[0] or 0
    n = F.col("id")
    # n * GOLDEN modulo 2**32 in halves, so that nothing overflows
    low, high = n.bitwiseAND(0xFFFF), F.shiftright(n, 16).bitwiseAND(0xFFFF)
    upper = F.shiftleft((high * GOLDEN).bitwiseAND(0xFFFF), 16)
    point = (low * GOLDEN + upper).bitwiseAND((1 << LINE_BITS) - 1)
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    points = points.withColumn("cell", F.shiftright("point", CELL_BITS))

    def edge(needed: Column) -> Column:
        return F.ceil(needed / F.lit(float(max(slots, 1))) * float(1 << LINE_BITS)).cast("bigint")

    by_name = Window.orderBy("source_key")
    until = F.sum("need").over(by_name)
    parts = sources.where("need > 0").select(
        "source_key", "need", edge(until - F.col("need")).alias("from"), edge(until).alias("to")
    )
    cells = F.explode(F.sequence(F.shiftright("from", CELL_BITS), F.shiftright(F.col("to") - 1, CELL_BITS)))
    parts = parts.where(F.col("from") < F.col("to")).withColumn("cell", cells)
    inside = (F.col("point") >= F.col("from")) & (F.col("point") < F.col("to"))
    dealt = points.join(parts, "cell").where(inside).select("slot", "source_key", "need")
    dealt = dealt.withColumn("chunk", F.expr(f"slot div {CHUNK}"))

    counts = dealt.groupBy("source_key", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inner = F.row_number().over(Window.partitionBy("source_key", "chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("inner", inner).join(offsets, ["source_key", "chunk"])
    ranked = ranked.withColumn("rank", F.col("offset") + F.col("inner")).where("rank < need")

    got = dealt.groupBy("source_key").agg(F.count("*").alias("got"))
    short = sources.join(got, "source_key", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("bigint")))
    short = short.where("got < need").withColumn("missing", F.col("need") - F.col("got"))
    before = F.sum("missing").over(by_name) - F.col("missing")
    late = short.withColumn("before", before).select(
        "source_key", "got", "before", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("missing") - 1)).alias("k")
    )
    late = late.select((F.lit(slots) + F.col("before") + F.col("k")).alias("slot"), "source_key", (F.col("got") + F.col("k")).alias("rank"))
    return ranked.select("slot", "source_key", "rank").unionByName(late)


def _started(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's first word in its source's order, by sums over digits of the hash."""
    leaves = sized.groupBy("source_key", "d1", "d2").agg(F.sum("size").alias("in_leaf"))
    branches = leaves.groupBy("source_key", "d1").agg(F.sum("in_leaf").alias("in_branch"))
    over = Window.partitionBy("source_key").orderBy("d1").rowsBetween(Window.unboundedPreceding, -1)
    branches = branches.withColumn("start", F.coalesce(F.sum("in_branch").over(over), F.lit(0)))
    branches = branches.join(sources.select("source_key", "source_size", "target", "budget"), "source_key")
    over = Window.partitionBy("source_key", "d1").orderBy("d2").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("inner", F.coalesce(F.sum("in_leaf").over(over), F.lit(0)))
    leaves = leaves.join(branches.drop("in_branch"), ["source_key", "d1"])
    leaves = leaves.withColumn("start", F.col("start") + F.col("inner")).drop("in_leaf", "inner")
    by_place = Window.partitionBy("source_key", "d1", "d2").orderBy("place", "size", *_kept(sized))
    ahead = F.coalesce(F.sum("size").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = sized.withColumns({"ahead": ahead, "nth": F.row_number().over(by_place)})
    ordered = ordered.join(leaves, ["source_key", "d1", "d2"])
    return ordered.withColumn("start", F.col("start") + F.col("ahead")).drop("ahead")


def _kept(sized: DataFrame) -> list[str]:
    return [c for c in sized.columns if c.startswith("_keep_")]


def _pieces(started: DataFrame, mix: Mix) -> DataFrame:
    """The parts of documents that fall into blocks below the budget; one row without a block otherwise."""
    again = F.explode(F.sequence(F.lit(0), F.lit(mix.most - 1)))
    passes = started.withColumn("again", again)
    begin = F.col("again") * F.col("source_size") + F.col("start")
    passes = passes.withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("budget")))
    taken = F.expr(f"sequence(begin div {mix.block}, (end - 1) div {mix.block})")
    blocks = F.when(F.col("begin") < F.col("end"), taken)
    cut = passes.withColumn("block", F.explode_outer(blocks))
    words = F.least("end", (F.col("block") + 1) * mix.block) - F.greatest("begin", F.col("block") * mix.block)
    return cut.withColumn("words", words)


def mix_sources(docs: DataFrame, keep: Sequence[str] = ("doc_id",), mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """Placements and totals of mixing ``docs`` (columns ``doc_id, text, source`` and those in ``keep``).

    Placements: ``slot``, ``keep`` and ``words`` taken there. Totals, one row per row of ``docs``:
    ``keep``, ``size``, ``source_size``, ``target`` (its source's) and ``taken`` words.
    """
    spark = docs.sparkSession
    sized = materialize(_sized(docs, keep, mix), "sized")
    sources = materialize(targets(sized, mix), "sources")
    slots = schedule(spark, sources)
    pieces = _pieces(_started(sized, sources), mix)
    slots = slots.withColumnRenamed("rank", "block")
    placed = pieces.join(slots, ["source_key", "block"], "left")
    row = ["source_key", "d1", "d2", "nth", "size", "source_size", "target", *_kept(sized)]
    words = F.when(F.col("slot").isNotNull(), F.col("words"))
    totals = placed.groupBy(*row).agg(F.coalesce(F.sum(words), F.lit(0).cast("bigint")).alias("taken"))
    names = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]
    placements = placed.where("slot IS NOT NULL").select("slot", *names, "words")
    return placements, totals.select(*names, "size", "source_size", "target", "taken")
