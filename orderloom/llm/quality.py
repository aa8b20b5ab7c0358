"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at counts of one text and votes good (+1), bad (-1) or abstains
(0). Rules differ in how often they are right, so their votes are not required
to agree: expectation-maximisation estimates how often each rule votes which way
on good texts and on each kind of bad text, and every text gets the posterior
probability of being good.

All that EM needs is how many texts have each pattern of votes. With R rules
there are at most 3**R patterns, however many texts there are, so the pattern
counts are the one thing that comes to the driver.

Defined cases: a null or empty text has no words, all counts 0 and fails the
base test. Repeated rows are judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.words import SPACES, combine, per_batch, row_sums, split_words

# The symbols that count as such, and the base test.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_upper", "n_lower", "n_marks", "n_long_words",
)
LONG_WORD = 25


def _repeat_words(hashes: np.ndarray, rows: np.ndarray, row_of: np.ndarray) -> np.ndarray:
    """Words that lie in a 3-word window which its text holds twice or more."""
    inside = np.zeros(len(hashes), bool)
    if len(hashes) >= 3:
        window = combine(hashes[:-2], hashes[1:-1], hashes[2:], row_of[:-2].astype(np.uint64))
        own = row_of[:-2] == row_of[2:]
        at = np.flatnonzero(own)
        order = np.argsort(window[at], kind="stable")
        ordered = window[at][order]
        same = np.zeros(len(ordered) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        twice = at[order[same[1:] | same[:-1]]]
        for k in range(3):
            inside[twice + k] = True
    return row_sums(inside, rows)


def _line_counts(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def _deleted(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = batch.column(batch.schema.get_field_index("_text")).cast(pa.large_string()).fill_null("")
    words = split_words(column, fold=False)
    upper, lower = bytes(range(65, 91)), bytes(range(97, 123))
    rest = []
    for text in column.cast(pa.large_binary()):
        raw = text.as_py()
        lines, repeated = _line_counts(raw)
        rest.append((
            _deleted(raw, SPACES), _deleted(raw, SYMBOLS.encode()), repeated, lines,
            _deleted(raw, upper), _deleted(raw, lower), _deleted(raw, b"!?"),
            sum(len(w) > LONG_WORD for w in raw.split()),
        ))
    rest = np.array(rest, np.int64).reshape(-1, 8)
    chars = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    got = {
        "n_words": words.counts(),
        "word_chars": chars - rest[:, 0],
        "n_symbols": rest[:, 1],
        "n_dup_lines": rest[:, 2],
        "n_repeat_words": _repeat_words(words.hashes, words.rows, words.row_of()),
        "n_lines": rest[:, 3],
        "n_upper": rest[:, 4],
        "n_lower": rest[:, 5],
        "n_marks": rest[:, 6],
        "n_long_words": rest[:, 7],
    }
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n != "_text"]
    arrays = [x for _, x in kept] + [pa.array(got[n], pa.int64()) for n in COUNTS]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in kept] + list(COUNTS))


def text_counts(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The counts that rules look at, one row per row of ``docs``, with the columns ``keep``."""
    taken = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    counts = ", ".join(f"{n} bigint" for n in COUNTS)
    return taken.mapInArrow(per_batch("_text", _count), f"{schema}, {counts}")


def base_failed() -> Column:
    too_much = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | too_much


@dataclass(frozen=True)
class Rule:
    """A vote by a measure: bad from ``bad`` on, good up to ``good``, abstaining between or without one."""

    name: str
    measure: Column
    good: float
    bad: float

    def vote(self) -> Column:
        seen = F.when(self.measure >= self.bad, -1).when(self.measure <= self.good, 1)
        return seen.otherwise(0).cast("tinyint").alias(self.name)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))


def default_rules() -> list[Rule]:
    letters = F.col("n_upper") + F.col("n_lower")
    return [
        Rule("symbols", _share("n_symbols", "n_words"), 0.05, 0.25),
        Rule("repeated_words", _share("n_repeat_words", "n_words"), 0.10, 0.30),
        Rule("repeated_lines", _share("n_dup_lines", "n_lines"), 0.10, 0.34),
        Rule("capitals", F.col("n_upper") / F.when(letters >= 40, letters), 0.20, 0.50),
        Rule("marks", _share("n_marks", "n_words"), 0.05, 0.25),
        Rule("long_words", _share("n_long_words", "n_words"), 0.10, 0.30),
        Rule("word_length", F.abs(_share("word_chars", "n_words") - 6.0), 2.5, 4.5),
        Rule("few_words", -F.col("n_words"), -80, -20),
    ]


@dataclass(frozen=True)
class VoteModel:
    """Class 0 is good, class r + 1 is the kind of bad text whose main fault rule r names.

    ``shares[z]`` is how common class z is; ``bad[r][z]`` is how often rule r, when it
    does not abstain, votes bad on a text of class z. An abstention says nothing.
    """

    rules: tuple[str, ...]
    shares: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    def accuracies(self) -> dict[str, float]:
        """Per rule, the chance that a vote is right."""
        out = {}
        for name, rate in zip(self.rules, self.bad):
            found = sum(p * q for p, q in zip(self.shares[1:], rate[1:]))
            out[name] = self.shares[0] * (1 - rate[0]) + found
        return out

    def posteriors(self) -> np.ndarray:
        """The probability of being good for each of the 3**R vote patterns, by pattern number."""
        votes = np.indices((3,) * len(self.rules)).reshape(len(self.rules), -1).T - 1
        bad = np.array(self.bad)
        odds = np.log(self.shares) + (votes < 0) @ np.log(bad) + (votes > 0) @ np.log(1 - bad)
        part = np.exp(odds - odds.max(1, keepdims=True))
        return part[:, 0] / part.sum(1)

    def add_posterior(self, voted: DataFrame, name: str = "p_good") -> DataFrame:
        """Look the votes' pattern up in the table of all patterns, whose size the rules bound."""
        number = F.lit(0)
        for rule in self.rules:
            number = number * 3 + F.col(rule) + 1
        rows = list(enumerate(self.posteriors().tolist()))
        table = voted.sparkSession.createDataFrame(rows, f"_pattern int, `{name}` double")
        return voted.withColumn("_pattern", number.cast("int")).join(F.broadcast(table), "_pattern", "left").drop("_pattern")


# What the model believes before it sees votes: how often a vote is bad on a good text, on a
# text with the fault that the rule names, and on a text with another fault; how many are good.
ON_GOOD, ON_ITS_FAULT, ON_OTHER = 0.002, 0.90, 0.10
GOOD_SHARE = 0.85


def fit_votes(
    voted: DataFrame, rules: Sequence[str], rounds: int = 100, belief: float = 20.0, trust: float = 20.0
) -> VoteModel:
    """EM over the counts of vote patterns of the whole table.

    The start is also a prior of weight ``belief`` pseudo-texts per class; without
    texts the prior is the model. Bad texts of different kinds share no faults, so
    each kind has a class of its own: one joint class would model the commonest
    kind and leave the others to the good class. And as a fault that comes alone
    looks the same as a rule that errs at that rate, votes alone cannot tell the
    two apart: the belief that rules seldom call a good text bad has ``trust``
    times the weight of the table.
    """
    counted = voted.groupBy(*rules).agg(F.count("*").alias("_n")).collect()
    votes = np.array([[row[r] for r in rules] for row in counted], int).reshape(-1, len(rules))
    weight = np.array([row["_n"] for row in counted], float)
    says_bad, says_good = (votes < 0).astype(float), (votes > 0).astype(float)
    classes = len(rules) + 1
    prior = np.full((len(rules), classes), ON_OTHER)
    prior[:, 0] = ON_GOOD
    prior[np.arange(len(rules)), np.arange(len(rules)) + 1] = ON_ITS_FAULT
    strength = np.full(classes, belief)
    strength[0] += trust * weight.sum()
    expected = np.array([GOOD_SHARE] + [(1 - GOOD_SHARE) / len(rules)] * len(rules))
    bad, shares = prior.copy(), expected.copy()
    for _ in range(rounds):
        odds = np.log(shares) + says_bad @ np.log(bad) + says_good @ np.log(1 - bad)
        part = np.exp(odds - odds.max(axis=1, initial=-np.inf, keepdims=True))
        part = part / part.sum(1, keepdims=True) * weight[:, None]
        shares = (part.sum(0) + belief * expected) / (weight.sum() + belief)
        against, all_votes = says_bad.T @ part, (says_bad + says_good).T @ part
        bad = (against + strength * prior) / (all_votes + strength)
    return VoteModel(tuple(rules), tuple(shares.tolist()), tuple(map(tuple, bad.tolist())))


def judge(
    counts: DataFrame, rules: Sequence[Rule] | None = None, least: float = 0.5
) -> tuple[DataFrame, VoteModel]:
    """Add the votes, ``p_good``, ``base_failed`` and ``kept`` to the output of ``text_counts``."""
    rules = list(rules or default_rules())
    names = [rule.name for rule in rules]
    voted = counts.select("*", *[rule.vote() for rule in rules])
    model = fit_votes(voted, names)
    out = model.add_posterior(voted).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least)), model
