from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT = st.text(st.sampled_from("aAbZ09 \t\n\x0b.-éß  日"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.booleans(), st.sampled_from([3, 7, 1 << 16]))
def test_words_are_those_of_the_patterns(column, alnum, piece):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" if alnum else r"[^\x20\x09-\x0D]+"
    expected = [re.findall(pattern, (t or "").translate(LOWER)) for t in column]
    before, words.PIECE = words.PIECE, piece
    try:
        found = words.split_words(pa.array(column, pa.string()), alnum=alnum)
    finally:
        words.PIECE = before
    assert found.counts().tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    assert len(set(flat)) == len(set(found.hashes.tolist())) == len(set(zip(flat, found.hashes.tolist())))


def test_batches_are_cut_by_bytes_and_keep_their_rows():
    batch = pa.RecordBatch.from_pydict({"t": ["aaaa", None, "bb", "c" * 50, "", "d"]})
    parts = list(words.bytewise([batch], "t", 8))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) == 2
