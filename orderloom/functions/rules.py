"""Validation rules as plain columns.

Each rule group yields one reason or null: inside a group the first hit wins,
across groups every reason is kept, in group order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions import domain, text


# A rule is a condition, as a column or as SQL over the order's columns, and its reason.
Rule = tuple[Column | str, str]
Group = Sequence[Rule]


def first_hit(*rules: tuple[Column, str]) -> Column:
    """The reason of the first condition that holds, else null."""
    condition, reason = rules[0]
    chain = F.when(condition, F.lit(reason))
    for condition, reason in rules[1:]:
        chain = chain.when(condition, F.lit(reason))
    return chain


def code_rule(
    code: Column, repeated: Column, stored: Column, registry_first: bool = False
) -> Column:
    in_file = (repeated, domain.REPEATED_CODE)
    in_registry = (stored, domain.STORED_CODE)
    rest = (in_registry, in_file) if registry_first else (in_file, in_registry)
    return first_hit((code == "", domain.MISSING_CODE), *rest)


def customer_rule(name: Column) -> Column:
    return first_hit(
        (name == "", domain.MISSING_CUSTOMER),
        (F.length(name) < domain.MIN_CUSTOMER_LENGTH, domain.SHORT_CUSTOMER),
    )


def quantity_rule(quantity: Column) -> Column:
    return first_hit(
        (quantity == "", domain.MISSING_QUANTITY),
        (~text.is_number(quantity), domain.QUANTITY_NOT_A_NUMBER),
        (text.to_quantity(quantity).isNull(), domain.QUANTITY_OUT_OF_RANGE),
        (text.to_quantity(quantity) <= 0, domain.QUANTITY_NOT_POSITIVE),
    )


def status_rule(status: Column, statuses: Sequence[str] = domain.STATUSES) -> Column:
    return first_hit((~status.isin(*statuses), domain.INVALID_STATUS))


# Stands for "no reason" inside an array; no reason reads like this.
_NONE = "\x00"


def collect_reasons(*groups: Column) -> Column:
    """The reasons that fired, in group order.

    Not ``array_compact``: that is a lambda, under which Spark interprets all the rules row by row.
    """
    held = [F.coalesce(group, F.lit(_NONE)) for group in groups]
    return F.array_remove(F.array(*held), _NONE)


def group_reasons(groups: Sequence[Group]) -> list[Column]:
    """One reason or null for each group given as data; a condition that is null does not hold."""
    compiled = []
    for group in groups:
        pairs = [(F.expr(c) if isinstance(c, str) else c, reason) for c, reason in group]
        compiled.append(first_hit(*pairs))
    return compiled


def field_reasons(statuses: Sequence[str] = domain.STATUSES) -> tuple[Column, Column, Column]:
    """The three groups that look at one row only."""
    return (
        customer_rule(F.col("customer_name")),
        quantity_rule(F.col("quantity")),
        status_rule(F.col("status"), statuses),
    )


def is_valid(errors: str = "errors") -> Column:
    return F.size(errors) == 0
