"""Small awkward tables: nulls everywhere, empty and very long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns whose names the operators use themselves.
CLASHING = DOCS + ", n_words bigint, kept boolean, size bigint, taken bigint, spans string, root bigint, a string, b string"


def prose(seed: int, n: int, words: int = 300) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


def texts() -> list[str | None]:
    base = prose(1, 200)
    changed = " ".join(w if i % 40 else "other" for i, w in enumerate(base.split()))
    return [
        None, "", " \t\n", "one", "one two", "One  two\nthree four five", base, base, base.upper(), changed,
        prose(2, 120), "é ü ß  x", "a\nb\na\nb\n\n \n", "rep eat it " * 40, "### $$$ %%% " * 30,
        prose(3, 9000), " ".join(["same"] * 3000), "x" * 70_000, "x" * 70_000 + " y",
    ]


def documents(spark):
    rows = [(i, t, "en" if i % 3 else None, (None, "a", "b", "c")[i % 4], None) for i, t in enumerate(texts())]
    rows += [rows[6], rows[6], (None, "no id", None, None, None), (None, None, None, None, None), (rows[10][0], prose(4, 60), None, "b", 1)]
    return spark.createDataFrame(rows, DOCS)


def clashing(spark):
    rows = [(i, t, "en", "a", 1, 7, True, 7, 7, "s", 7, "a", "b") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, CLASHING)


def nothing(spark):
    return spark.createDataFrame([], DOCS)
