"""Intake: normalize raw orders, validate them, summarise the outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import domain, rules, text
from orderloom.operators import codes


def normalize_orders(raw: DataFrame) -> DataFrame:
    """Normalize the four order fields; a missing column counts as empty. Other columns stay."""

    def field(name: str):
        return F.col(name) if name in raw.columns else F.lit("")

    return raw.withColumns(
        {
            "order_code": text.order_code(field("order_code")),
            "customer_name": text.customer_name(field("customer_name")),
            "quantity": text.clean_text(field("quantity")),
            "status": text.status(field("status")),
        }
    )


def _with_errors(
    flagged: DataFrame,
    statuses: Sequence[str],
    registry_first: bool = False,
    more: Sequence[rules.Group] = (),
) -> DataFrame:
    code = rules.code_rule(
        F.col("order_code"), F.col("repeated"), F.col("stored"), registry_first
    )
    errors = rules.collect_reasons(
        code, *rules.field_reasons(statuses), *rules.group_reasons(more)
    )
    return flagged.withColumn("errors", errors).drop("repeated", "stored")


def validate(
    raw: DataFrame,
    registry: DataFrame | None = None,
    statuses: Sequence[str] = domain.STATUSES,
    more: Sequence[rules.Group] = (),
) -> DataFrame:
    """Normalized orders with an ``errors`` array.

    ``raw`` carries a unique, ordered ``pos``; ``registry`` the stored
    ``order_code`` values. ``more`` are rule groups of one's own, after the four
    built in: lists of (condition, reason), the first condition that holds counts.
    They see the normalized fields, ``repeated``, ``stored`` and all other columns.
    """
    flagged = codes.flag_codes(normalize_orders(raw), registry)
    return _with_errors(flagged, statuses, more=more)


def validate_creations(
    raw: DataFrame, registry: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """Validate candidates as if each were created alone, in ``pos`` order.

    There is no in-file check, but a created order is stored at once: from the
    first candidate of a code that passes, later ones find the code stored.
    """
    candidates = normalize_orders(raw).withColumn(
        "_reasons", rules.collect_reasons(*rules.field_reasons(statuses))
    )
    # A conditional minimum, not a filter: a filter would be pushed below the
    # normalization and compute every rule once more.
    created = candidates.groupBy("order_code").agg(
        F.min(F.when(F.size("_reasons") == 0, F.col("pos"))).alias("_created")
    )
    facts = codes.mark_stored(created, registry)
    flagged = candidates.join(facts, "order_code", "left").withColumns(
        {
            "repeated": F.lit(False),
            "stored": F.coalesce("stored", F.col("pos") > F.col("_created"), F.lit(False)),
        }
    )
    return _with_errors(flagged.drop("_created", "_reasons"), statuses)


def validate_drops(
    raw: DataFrame, registry: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """Validate several drops at once as if each was loaded before the next one was looked at.

    ``raw`` carries the number of its ``drop`` and a ``pos`` that goes on over the drops. A code
    repeats inside its drop only; from the first drop whose first row of the code passes, later
    drops find the code stored.
    """
    candidates = normalize_orders(raw).withColumn(
        "_reasons", rules.collect_reasons(*rules.field_reasons(statuses))
    )
    passes = (F.size("_reasons") == 0) & (F.col("order_code") != "")
    firsts = candidates.groupBy("order_code", "drop").agg(
        F.min("pos").alias("pos"), F.min_by(passes, F.col("pos")).alias("_passes")
    )
    loaded = firsts.groupBy("order_code").agg(F.min(F.when(F.col("_passes"), F.col("drop"))).alias("_loaded"))
    known = codes.mark_stored(loaded, registry)
    facts = firsts.join(known, "order_code").select(
        "order_code",
        "pos",
        F.coalesce("stored", F.col("drop") > F.col("_loaded"), F.lit(False)).alias("stored"),
        F.lit(True).alias("_is_first"),
    )
    flagged = candidates.join(facts, ["order_code", "pos"], "left").withColumns(
        {
            "repeated": (F.col("order_code") != "") & F.col("_is_first").isNull(),
            "stored": F.coalesce("stored", F.lit(False)),
        }
    )
    return _with_errors(flagged.drop("_is_first", "_reasons"), statuses)


def validate_legacy(
    raw: DataFrame, registry: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """The earlier rule set: values as they are, and the registry checked before the file."""
    plain = raw.withColumns(
        {name: F.coalesce(name, F.lit("")) for name in domain.ORDER_FIELDS}
    )
    return _with_errors(
        codes.flag_codes_on_every_row(plain, registry), statuses, registry_first=True
    )


def accepted(validated: DataFrame) -> DataFrame:
    """Valid rows with the quantity as an integer."""
    return (
        validated.where(rules.is_valid())
        .withColumn("quantity", text.to_quantity(F.col("quantity")))
        .drop("errors")
    )


def rejected(validated: DataFrame) -> DataFrame:
    """Invalid rows with their reasons, also as one text."""
    return validated.where(~rules.is_valid()).withColumn(
        "reasons", F.array_join("errors", "; ")
    )


def preview_counts(validated: DataFrame) -> DataFrame:
    """One row: how many orders there are, would load, and would be skipped."""
    return validated.agg(
        F.count("*").alias("total_orders"),
        F.count_if(rules.is_valid()).alias("valid_orders"),
        F.count_if(~rules.is_valid()).alias("invalid_orders"),
        (F.count("*") > 0).alias("requires_confirmation"),
    )


def reason_summary(validated: DataFrame) -> DataFrame:
    """How often each reason fired, in order of first appearance (``first_pos``).

    Reasons that first appear in the same row follow the order of the rule groups.
    """
    fired = validated.select("pos", F.posexplode("errors").alias("place", "reason"))
    counted = fired.groupBy("reason").agg(
        F.count("*").alias("count"),
        F.min("pos").alias("first_pos"),
        F.min_by("place", "pos").alias("place"),
    )
    return counted.orderBy("first_pos", "place").drop("place")


def report_entries(validated: DataFrame) -> DataFrame:
    """One report block per rejected order."""
    block = F.concat(
        F.lit("Order code: "), "order_code",
        F.lit("\nCustomer name: "), "customer_name",
        F.lit("\nQuantity: "), "quantity",
        F.lit("\nStatus: "), "status",
        F.lit("\nErrors:\n- "), F.array_join("errors", "\n- "),
        F.lit("\n"),
    )
    return rejected(validated).select("pos", block.alias("entry"))
