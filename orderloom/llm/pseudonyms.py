"""Format-preserving pseudonyms for personal numbers and dates, with DataFrame functions only.

A text is split at everything that looks like a value, each value is validated
(Luhn, mod 97, octets, calendar, number ranges), and valid ones are replaced by
a keyed Feistel permutation of all values of their format: a card number becomes
a card number with a right check digit, a date a date between 1900 and 2099, an
address an address. Equal values get equal pseudonyms in all documents, and with
the key a pseudonym can be traced back. What is not valid stays as it is.

Numbers that count something (dates, addresses, social security numbers) are a
pair of residues; digit strings and mail names are two halves of characters, a
letter staying a letter of its case and a digit a digit. Each round shifts one
side by a keyed hash of the other, which any key and any sizes make invertible.

IBANs in groups of four are looked for first, by the length of their country, so
that their digits are not taken for a card; one that is not valid is text like any
other. A phone number with + keeps its country code, and other values keep their
blanks and hyphens, so all written forms of a card or an IBAN have one pseudonym.

Defined cases: a null text stays null; text without values stays the same;
values longer than their format's bound are no values. Dates written with the
year last are taken day first where that is a date, month first otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 17 * 4297 days end with the year 2099
AREAS, GROUPS_SERIALS = 898, 99 * 9999

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
YEAR_FIRST = r"[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}"
YEAR_LAST = r"[0-9]{2}[./][0-9]{2}[./][0-9]{4}"
IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
GROUPED_CARD = r"[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
CARD = GROUPED_CARD + r"|[0-9]{13,19}"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
# With + and country code: ten more digits after 1, else at most 15 digits, in any groups.
INTERNATIONAL = (
    r"\+(?!(?:" + "|".join([YEAR_FIRST, YEAR_LAST, ADDRESS, GROUPED_CARD]) + r")(?![0-9]))"
    r"(?:1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|[2-9](?:(?:[ .-]|[ .-]?\(|\)[ .-]?)?[0-9]){6,14})"
)
COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# Lengths of IBANs as registered.
IBAN_LANDS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _in_fours(n: int, lands: str) -> str:
    rest = f" [A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return f"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}"


# Values stand apart from letters and digits, and an address from further numbered parts.
VALUE = (
    r"(?<![A-Za-z0-9._%+-])(?:" + EMAIL + r")|(?<![A-Za-z0-9]|[0-9][./-])(?:"
    + "|".join([YEAR_FIRST, YEAR_LAST, IBAN, SOCIAL, ADDRESS, CARD, PHONE, INTERNATIONAL])
    + r")(?![A-Za-z0-9]|[./-][0-9])"
)
IBAN_IN_FOURS = (
    r"(?<![A-Za-z0-9]|[0-9][./-])(?:" + "|".join(_in_fours(n, lands) for n, lands in IBAN_LANDS.items())
    + r")(?![A-Za-z0-9]|[./-][0-9])"
)


def _number(key: str, kind: str, *parts: Column) -> Column:
    """A 48-bit number from a keyed hash."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("bigint")


def permute_pair(key: str, kind: str, a: Column, b: Column, sizes: tuple[int, int]) -> Column:
    """A permutation of pairs of residues: ``struct<a, b>``."""

    def round_(state: Column, r: Column) -> Column:
        left = (state["a"] + _number(key, kind, r, F.lit("a"), state["b"])) % sizes[0]
        return F.struct(left.alias("a"), state["b"].alias("b"))

    def other(state: Column, r: Column) -> Column:
        right = (state["b"] + _number(key, kind, r, F.lit("b"), state["a"])) % sizes[1]
        return F.struct(state["a"].alias("a"), right.alias("b"))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, lambda s, r: F.when(r % 2 == 1, round_(s, r)).otherwise(other(s, r)))


def _shift(key: str, kind: str, text: Column, by: Column, r: Column) -> Column:
    """Shift each letter and digit of ``text`` within its class by a keyed hash of ``by`` and its place."""

    def moved(c: Column, i: Column) -> Column:
        def within(first: int, size: int) -> Column:
            return F.char((F.lit(first) + (F.ascii(c) - first + _number(key, kind, r, i, by)) % size).cast("bigint"))

        return (
            F.when(c.between("0", "9"), within(48, 10))
            .when(c.between("A", "Z"), within(65, 26))
            .when(c.between("a", "z"), within(97, 26))
            .otherwise(c)
        )

    return F.when(text == "", text).otherwise(F.array_join(F.transform(F.split(text, ""), moved), ""))


def permute_characters(key: str, kind: str, text: Column) -> Column:
    """A permutation of texts with the same classes of characters at the same places."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(text.substr(F.lit(1), half).alias("a"), text.substr(half + 1, F.length(text)).alias("b"))

    def round_(state: Column, r: Column) -> Column:
        odd = F.struct(_shift(key, kind, state["a"], state["b"], r).alias("a"), state["b"].alias("b"))
        even = F.struct(state["a"].alias("a"), _shift(key, kind, state["b"], state["a"], r).alias("b"))
        return F.when(r % 2 == 1, odd).otherwise(even)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)
    return F.concat(done["a"], done["b"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, one after the other, by ``digits``."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def put(state: Column, c: Column) -> Column:
        digit = F.struct(
            F.concat(state["text"], digits.substr(state["next"], F.lit(1))).alias("text"), (state["next"] + 1).alias("next")
        )
        kept = F.struct(F.concat(state["text"], c).alias("text"), state["next"].alias("next"))
        return F.when(c.between("0", "9"), digit).otherwise(kept)

    return F.aggregate(F.split(form, ""), start, put)["text"]


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """The Luhn sum; ``doubled_last`` for a number whose check digit is still to come."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == (0 if doubled_last else 1), twice).otherwise(d)

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d)


def _card(key: str, value: Column) -> Column:
    digits = _digits(value)
    body = permute_characters(key, "card", digits.substr(F.lit(1), F.length(digits) - 1))
    check = (10 - _luhn_sum(body, True) % 10) % 10
    return F.when(_luhn_sum(digits, False) % 10 == 0, _refilled(value, F.concat(body, check.cast("string"))))


def _iban_rest(text: Column) -> Column:
    """The number that a text stands for, letters being 10 to 35, modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(key: str, value: Column) -> Column:
    land, account = value.substr(1, 2), value.substr(F.lit(5), F.length(value))
    valid = _iban_rest(F.concat(account, value.substr(1, 4))) == 1
    other = permute_characters(key, "iban", account)
    check = 98 - _iban_rest(F.concat(other, land, F.lit("00")))
    return F.when(valid, F.concat(land, F.lpad(check.cast("string"), 2, "0"), other))


def _iban_in_fours(key: str, value: Column) -> Column:
    return F.regexp_replace(_iban(key, F.replace(value, F.lit(" "), F.lit(""))), "(.{4})(?=.)", "$1 ")


def _address(key: str, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("int"))
    plain = value.rlike(r"^(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}$")
    valid = plain & F.forall(parts, lambda p: p <= 255)
    pair = permute_pair(
        key, "address", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (65536, 65536)
    )
    dotted = [F.floor(pair[n] / 256).cast("string") if high else (pair[n] % 256).cast("string") for n in "ab" for high in (1, 0)]
    return F.when(valid, F.concat_ws(".", *dotted))


def _social(key: str, value: Column) -> Column:
    area, group, serial = (value.substr(a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permute_pair(key, "social", place, (group - 1) * 9999 + serial - 1, (AREAS, GROUPS_SERIALS))
    back = pair["a"] + 1 + F.when(pair["a"] >= 665, 1).otherwise(0)
    parts = [(back, 3), (F.floor(pair["b"] / 9999) + 1, 2), (pair["b"] % 9999 + 1, 4)]
    return F.when(valid, F.concat_ws("-", *[F.lpad(p.cast("bigint").cast("string"), n, "0") for p, n in parts]))


def _other_day(key: str, day: Column) -> Column:
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    pair = permute_pair(key, "date", F.floor(number / DAYS[1]), number % DAYS[1], DAYS)
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (pair["a"] * DAYS[1] + pair["b"]).cast("int"))


def _date(key: str, value: Column, *forms: str) -> Column:
    """Written like ``value``, in the first of the forms (with - for the separator) that makes it a date."""
    separator = F.regexp_extract(value, "([-/.])", 1)
    plain = F.translate(value, "/.", "--")
    out = None
    for form in forms:
        day = F.try_to_timestamp(plain, F.lit(form)).cast("date")
        known = day.isNotNull() & F.year(day).between(1900, 2099)
        other = F.replace(F.date_format(_other_day(key, day), form), F.lit("-"), separator)
        out = F.when(known, other) if out is None else out.when(known, other)
    return out


def _email(key: str, value: Column) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(permute_characters(key, "mail", name), value.substr(F.length(name) + 1, F.length(value)))


def _phone(key: str, value: Column) -> Column:
    digits = _digits(value)
    land = digits.substr(F.lit(1), F.length(digits) - 10)
    return _refilled(value, F.concat(land, permute_characters(key, "phone", digits.substr(F.length(digits) - 9, F.lit(10)))))


def _international(key: str, value: Column) -> Column:
    digits = _digits(value)
    land = F.regexp_extract(digits, COUNTRY, 0)
    own = digits.substr(F.length(land) + 1, F.length(digits))
    return _refilled(value, F.concat(land, permute_characters(key, "phone", own)))


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of a value, null for what is not valid."""
    full = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (
        F.when(full(EMAIL), _email(key, value))
        .when(full(YEAR_FIRST), _date(key, value, "yyyy-MM-dd"))
        .when(full(YEAR_LAST), _date(key, value, "dd-MM-yyyy", "MM-dd-yyyy"))
        .when(full(IBAN), _iban(key, value))
        .when(full(SOCIAL), _social(key, value))
        .when(full(ADDRESS), _address(key, value))
        .when(full(CARD), _card(key, value))
        .when(full(PHONE), _phone(key, value))
        .when(full(INTERNATIONAL), _international(key, value))
    )


def pseudonymise(
    docs: DataFrame, key: str, keep: Sequence[str] = ("doc_id",), text: str = "text", name: str = "text"
) -> DataFrame:
    """``keep``, the text with pseudonyms as ``name``, and how many valid values were replaced."""
    column = F.col(f"`{text}`").cast("string")
    kept = [F.col(c) for c in keep]
    none = F.array().cast("array<string>")
    grouped = F.when(column.rlike(IBAN_IN_FOURS), F.regexp_extract_all(column, F.lit(IBAN_IN_FOURS), 0))
    located = docs.select(*kept, column.alias("_text"), F.coalesce(grouped, none).alias("_grouped"))
    located = located.withColumn("_ibans", F.transform("_grouped", lambda v: _iban_in_fours(key, v)))
    # The text between the valid ones, which is searched for all other values.
    spans = F.arrays_zip(F.split("_text", IBAN_IN_FOURS, -1).alias("piece"), F.col("_grouped").alias("old"), F.col("_ibans").alias("new"))
    start = F.struct(none.alias("parts"), F.lit("").alias("last"))

    def glue(state: Column, span: Column) -> Column:
        text = F.concat(state["last"], span["piece"])
        ended = F.struct(F.concat(state["parts"], F.array(text)).alias("parts"), F.lit("").alias("last"))
        longer = F.struct(state["parts"].alias("parts"), F.concat(text, F.coalesce(span["old"], F.lit(""))).alias("last"))
        return F.when(span["new"].isNotNull(), ended).otherwise(longer)

    glued = F.aggregate(spans, start, glue, lambda state: F.concat(state["parts"], F.array(state["last"])))
    located = located.withColumn("_parts", F.when(F.size("_grouped") == 0, F.array("_text")).otherwise(glued))
    found = F.transform(
        "_parts", lambda p: F.coalesce(F.when(p.rlike(r"[0-9@]"), F.regexp_extract_all(p, F.lit(VALUE), 0)), none)
    )
    changed = located.withColumn("_found", found)
    changed = changed.withColumn("_new", F.transform("_found", lambda values: F.transform(values, lambda v: pseudonym(key, v))))

    def put(part: Column, values: Column) -> Column:
        new = F.zip_with(values["old"], values["new"], lambda old, other: F.coalesce(other, old))
        pieces = F.split(part, VALUE, -1)
        joined = F.array_join(F.zip_with(pieces, new, lambda piece, v: F.concat(piece, F.coalesce(v, F.lit("")))), "")
        return F.when(F.size(values["old"]) == 0, part).otherwise(joined)

    pairs = F.zip_with("_found", "_new", lambda old, new: F.struct(old.alias("old"), new.alias("new")))
    parts = F.zip_with("_parts", pairs, put)
    ibans = F.filter("_ibans", lambda v: v.isNotNull())
    whole = F.array_join(F.zip_with(parts, ibans, lambda part, v: F.concat(part, F.coalesce(v, F.lit("")))), "")
    replaced = F.size(F.filter(F.flatten("_new"), lambda v: v.isNotNull())) + F.size(ibans)
    return changed.select(
        *kept,
        F.when(F.col("_text").isNotNull(), whole).alias(name),
        replaced.cast("bigint").alias("n_replaced"),
    )
