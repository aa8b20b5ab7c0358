"""Text normalization as native Spark expressions.

Spark's own ``trim`` knows only U+0020 and the JVM has no casefold, so the
Unicode sets used here are derived from Python's string methods at first use
and handed to ``btrim`` and ``translate`` as literals. No Python runs per row.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _code_points() -> list[str]:
    surrogates = range(0xD800, 0xE000)
    return [chr(c) for c in range(sys.maxunicode + 1) if c not in surrogates]


@lru_cache(maxsize=None)
def whitespace() -> str:
    """Every character Python's ``str.strip`` removes (all lie in the BMP)."""
    return "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def _char_class(chars: str, gap: int = 1) -> str:
    """A regex class of the characters, as ranges; ``gap`` > 1 may join near ranges."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point - ranges[-1][1] <= gap:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges) + "]"


@lru_cache(maxsize=None)
def _whitespace_run(ascii_only: bool) -> str:
    """A regex for each whitespace run that is not already one plain space."""
    spaces = "".join(c for c in whitespace() if not ascii_only or c.isascii())
    odd = spaces.replace(" ", "")
    return f"{_char_class(odd)}{_char_class(spaces)}*| {_char_class(spaces)}+"


@lru_cache(maxsize=None)
def _case_table(method: str) -> tuple[str, str, dict[str, str]]:
    """One-to-one pairs (as two aligned strings) and one-to-many pairs of a case mapping."""
    convert: Callable[[str], str] = getattr(str, method)
    single, several = {}, {}
    for char in _code_points():
        mapped = convert(char)
        if mapped != char:
            (single if len(mapped) == 1 else several)[char] = mapped
    return "".join(single), "".join(single.values()), several


@lru_cache(maxsize=None)
def _decimal_table() -> tuple[str, str]:
    """Decimal digits outside ASCII beside their ASCII digit."""
    pairs = {
        char: str(unicodedata.decimal(char))
        for char in _code_points()
        if char.isdecimal() and char > "9"
    }
    return "".join(pairs), "".join(pairs.values())


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a text that is computed once. Never null, so joins add no null check."""
    return F.coalesce(F.transform(F.array(value), body)[0], F.lit(""))


def _expand_rare(text: Column, pairs: dict[str, str]) -> Column:
    """Replace characters of a table, one by one; for the few rows that hold any."""
    listed = ",".join(f"{char}:{form}" for char, form in pairs.items())
    forms = F.str_to_map(F.lit(listed), F.lit(","), F.lit(":"))
    chars = F.transform(F.split(text, ""), lambda char: F.coalesce(forms[char], char))
    return F.array_join(chars, "")


def _map_case(text: Column, method: str, native: Callable[[Column], Column], like: str) -> Column:
    """A context-free Unicode case mapping that stays on the built-in function where it can.

    ASCII rows take the built-in alone. So do rows below U+0180 (Western and
    Central European letters), where it differs from the wanted mapping only in
    a few characters: sharp s is replaced, rows with another one go on. All
    other rows map one-to-one characters in one pass, then expand those with a
    longer form: the Latin-1 ones always, the rare rest behind a guard.
    ``like`` names Python's counterpart of the built-in function.
    """
    source, target, several = _case_table(method)
    latin = {char: form for char, form in several.items() if char < "\u0100"}
    rare = {char: form for char, form in several.items() if char not in latin}
    differing = "".join(
        char
        for char in map(chr, range(0x80, 0x180))
        if getattr(char, method)() != getattr(char, like)() and char not in latin
    )
    beyond = r"[^\x{0}-\x{17f}]" + (f"|{_char_class(differing)}" if differing else "")
    guard = _char_class("".join(rare), gap=128)

    def expand_latin(mapped: Column) -> Column:
        for char, form in latin.items():
            mapped = F.replace(mapped, F.lit(char), F.lit(form))
        return mapped

    def expand(simple: Column) -> Column:
        return F.when(simple.rlike(guard), _expand_rare(simple, rare)).otherwise(simple)

    return (
        F.when(is_ascii(text), native(text))
        .when(~text.rlike(beyond), expand_latin(native(text)))
        .otherwise(_let(expand_latin(F.translate(text, source, target)), expand))
    )


def upper(text: Column) -> Column:
    return _map_case(text, "upper", F.upper, "upper")


def casefold(text: Column) -> Column:
    return _map_case(text, "casefold", F.lower, "lower")


def clean_text(value: Column) -> Column:
    """Text without outer Unicode whitespace; a missing value is the empty string."""
    return F.btrim(F.coalesce(value.cast("string"), F.lit("")), F.lit(whitespace()))


def order_code(value: Column) -> Column:
    return upper(clean_text(value))


def status(value: Column) -> Column:
    return F.lower(clean_text(value))


def customer_name(value: Column) -> Column:
    """A readable name: outer whitespace removed, inner runs collapsed to one space."""
    cleaned = clean_text(value)
    return F.when(
        is_ascii(cleaned), F.regexp_replace(cleaned, _whitespace_run(ascii_only=True), " ")
    ).otherwise(F.regexp_replace(cleaned, _whitespace_run(ascii_only=False), " "))


def customer_key(value: Column) -> Column:
    """The case-insensitive key that identifies one customer."""
    return casefold(customer_name(value))


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as ASCII digits."""
    return F.when(is_ascii(text), text).otherwise(F.translate(text, *_decimal_table()))


def is_number(text: Column) -> Column:
    """True when the text is one or more decimal digits and nothing else."""
    return ascii_digits(text).rlike(r"\A[0-9]+\z")


def to_quantity(text: Column) -> Column:
    """The integer, signed or not, that a cleaned text stands for.

    Single underscores may stand between digits. Null when the text is no
    integer or exceeds 64 bits.
    """
    digits = ascii_digits(text)
    whole = digits.rlike(r"\A[+-]?[0-9]+(?:_[0-9]+)*\z")
    return F.when(whole, F.replace(digits, F.lit("_"), F.lit("")).try_cast("bigint"))
