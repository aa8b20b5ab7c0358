from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderloom.llm import pseudonyms
from tests.llm.samples import clashing, documents, nothing


def replaced(spark, values, key="k"):
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")
    return [r.text for r in pseudonyms.pseudonymise(docs, key).orderBy("doc_id").collect()]


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def with_check(body):
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def test_values_keep_their_format_and_links(spark):
    card = with_check("411111111111111")
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    values = [card, f"pay {card}, {spaced}!!", "+1 (017) 555-7713", "ip 10.0.255.1.", "UND.34@Mail7.example.com", "1984-02-29 29.02.1984 12/25/1999",
              "DE89370400440532013000", "123-45-6789"]
    new = replaced(spark, values)
    shape = lambda x: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", x)))
    for old, text in zip(values, new):
        assert old != text
        if "ip" not in old:
            assert shape(old) == shape(text)
    assert luhn(new[0]) and new[1].startswith(f"pay {new[0]}, ") and new[1].replace(" ", "").count(new[0]) == 2
    assert all(int(p) < 256 for p in re.search(r"ip (\S+)\.$", new[3])[1].split("."))
    assert new[4].endswith("@Mail7.example.com")
    iso, german, american = new[5].split()
    assert date.fromisoformat(iso) == date(*map(int, german.split(".")[::-1])) and 1900 <= int(iso[:4]) <= 2099
    assert 1 <= int(american[:2]) <= 12
    moved = new[6][4:] + new[6][:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    assert replaced(spark, values) == new != replaced(spark, values, "other key")


def test_written_forms_of_one_value(spark):
    shape = lambda x: re.sub("[A-Z]", "A", re.sub("[0-9]", "9", x))
    iban = "DE89370400440532013000"
    fours = " ".join(iban[i : i + 4] for i in range(0, 22, 4))
    amex = with_check("37828224631000")
    values = [
        f"to {fours} 1234 EUR, {fours}.", iban, f"{amex[:4]} {amex[4:10]}-{amex[10:]}", amex, "+15551234567 or +1 (555) 123-4567",
        "+44 20 7946 0958.", "+442079460958", "+49 30 123456", "+8613812345678", "BE68 5390 0754 7034 EUR",
        "GB82 WEST 1234 5698 7654 32 mail a@b.de", "+44 (0)20 7946 0958",
    ]
    new = replaced(spark, values)
    for old, text in zip(values, new):
        assert old != text and (shape(old) == shape(text) or "@" in old)
    own = " ".join(new[1][i : i + 4] for i in range(0, 22, 4))
    assert new[0] == f"to {own} 1234 EUR, {own}."
    assert re.sub("[ -]", "", new[2]) == new[3] and luhn(new[3])
    first, second = new[4].split(" or ")
    assert first.startswith("+1") and re.sub("[^0-9+]", "", second) == first
    assert new[5].startswith("+44 ") and new[5].replace(" ", "") == new[6] + "." and "7946 0958" not in new[5]
    assert new[7].startswith("+49 ") and new[8].startswith("+86")
    for text in (new[0][3:30], new[9][:19], new[10][:27]):
        text = text.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def test_groups_that_are_no_iban_are_text(spark):
    card = with_check("411111111111111")
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    plain, after = replaced(spark, [spaced, f"BE20 {spaced} and DE88 3704 0044 0532 0130 00 5"])
    assert after.startswith(f"BE20 {plain} and DE88 ") and plain != spaced
    stays = ["+1.2.3", "+12345", "+999.1.1.1", "1234 567890 12345", "XX89 3704 0044 0532 0130 0", None, ""]
    keep = [x for x in stays if x is None or not luhn(x)] + [""]
    assert replaced(spark, keep) == keep
    docs = spark.createDataFrame([(1, "GB82 WEST 1234 5698 7654 32 and a@b.de, BE68 5390 0754 7034")], "doc_id int, text string")
    assert pseudonyms.pseudonymise(docs, "k").first().n_replaced == 3


def test_what_is_not_valid_stays(spark):
    bad = ["9807915762804491 9807915762804492 98079157628044", "256.1.1.1 1.2.3.4.5 01.2.3.4", "2021-02-30 1850-01-01", "000-12-3456",
           "DE88370400440532013000", "a 12345 b", "x@y", "v1.2.3", "", None]
    keep = [b for b in bad if not (b and any(luhn(w) for w in b.split() if w.isdigit() and len(w) > 12))]
    assert replaced(spark, keep) == keep


def test_pairs_are_permuted(spark):
    sizes = (5, 7)
    pairs = spark.range(35).select(F.floor(F.col("id") / 7).alias("a"), (F.col("id") % 7).alias("b"))
    out = pairs.select(pseudonyms.permute_pair("k", "t", F.col("a"), F.col("b"), sizes).alias("p")).collect()
    assert {(r.p.a, r.p.b) for r in out} == {(a, b) for a in range(5) for b in range(7)}


def test_characters_are_permuted(spark):
    names = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("n"))
    out = names.select(pseudonyms.permute_characters("k", "t", F.col("n")).alias("p")).collect()
    assert len({r.p for r in out}) == 1000 and all(re.fullmatch("[0-9]{3}", r.p) for r in out)


def test_days_are_permuted(spark):
    days = spark.range(73_049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    found = days.select(pseudonyms._other_day("k", F.col("d")).alias("d")).agg(F.countDistinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(found) == (73_049, date(1900, 1, 1), date(2099, 12, 31))


@pytest.mark.parametrize("table", [documents, clashing, nothing])
def test_other_texts_are_left_alone(spark, table):
    docs = table(spark)
    rows = pseudonyms.pseudonymise(docs, "k").collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    assert all(r.n_replaced == 0 for r in rows)


def test_no_python_in_the_plan(spark):
    plan = pseudonyms.pseudonymise(documents(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
