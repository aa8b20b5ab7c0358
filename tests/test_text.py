"""Normalizers against Python's own string methods."""

from __future__ import annotations

import sys

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.functions import text

SPACES = st.sampled_from([" ", "  ", "\t", " ", " ", "\x1c", "\n"])
WORDS = st.text(
    st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ßŉﬁΣςİẞᾷKkǅ")),
    max_size=8,
)
VALUES = st.lists(st.one_of(SPACES, WORDS), max_size=6).map("".join)


def python_name(value: str) -> str:
    return " ".join(value.strip().split())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VALUES, min_size=200, max_size=400))
def test_normalizers_equal_python(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    rows = frame.select(
        v, text.clean_text(v), text.customer_name(v), text.customer_key(v), text.order_code(v)
    ).collect()
    for value, clean, name, key, code in rows:
        assert clean == value.strip()
        assert name == python_name(value)
        assert key == python_name(value).casefold()
        assert code == value.strip().upper()


def test_every_code_point(spark, tmp_path):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    expected = pd.DataFrame(
        {
            "c": points,
            "word": [f"a{c}b" for c in points],
            "spaced": [f"{c}x {c}y{c}{c}z{c}" for c in points],
        }
    )
    expected["upper"] = expected["word"].str.upper()
    expected["fold"] = [word.casefold() for word in expected["word"]]
    expected["name"] = [python_name(value) for value in expected["spaced"]]
    expected["number"] = [int(c + "7") if c.isdecimal() or c in "+-" else None for c in points]
    expected.astype({"number": "Int64"}).to_parquet(tmp_path / "points.parquet")
    frame = spark.read.parquet(str(tmp_path / "points.parquet")).repartition(8)
    word = F.col("word")
    checks = {
        "upper": ~(text.upper(word) == F.col("upper")),
        "fold": ~(text.casefold(word) == F.col("fold")),
        "name": ~(text.customer_name(F.col("spaced")) == F.col("name")),
        "number": ~text.to_quantity(F.concat("c", F.lit("7"))).eqNullSafe(F.col("number")),
    }
    wrong = frame.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])
    assert wrong.first().asDict() == dict.fromkeys(checks, 0)


def test_missing_and_other_types(spark):
    row = spark.sql("SELECT CAST(NULL AS STRING) AS a, 12 AS b, 1.5D AS c").select(
        text.clean_text(F.col("a")), text.clean_text(F.col("b")), text.order_code(F.col("c"))
    )
    assert tuple(row.first()) == ("", "12", "1.5")


@pytest.mark.parametrize(
    ("value", "quantity"),
    [
        ("7", 7),
        ("007", 7),
        ("٣", 3),
        ("", None),
        ("-5", -5),
        ("+5", 5),
        ("1_000", 1000),
        ("_1", None),
        ("--5", None),
        ("1.5", None),
        ("²", None),
        ("5\n", None),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
    ],
)
def test_quantity(spark, value, quantity):
    frame = spark.createDataFrame([(value,)], "q string")
    assert frame.select(text.to_quantity(F.col("q"))).first()[0] == quantity


def test_long_texts_are_processed_whole(spark):
    value = " " + "Straße ΑΣ   ﬁn " * 5000
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(text.customer_key(F.col("v"))).first()[0] == python_name(value).casefold()
