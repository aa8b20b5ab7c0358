from __future__ import annotations

import random

import pytest

from orderloom.llm import minhash
from orderloom.llm.components import components
from tests.llm.samples import clashing, documents, nothing, prose


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n):
    """Smallest reachable id per id; rows of one id are one node."""
    sets = [(r.doc_id, shingles(r.text, n)) for r in rows if r.doc_id is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def check(spark, docs, n):
    rows = docs.collect()
    expected = brute(rows, n)
    found = minhash.near_duplicates(docs, minhash.Settings(words=n)).collect()
    assert len(found) == len(rows)
    sizes = sorted((r.doc_id or -1, len(shingles(r.text, n))) for r in rows)
    assert sorted((r.doc_id or -1, r.n_shingles) for r in found) == sizes
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)


@pytest.mark.parametrize("n", [2, 5])
def test_awkward_rows(spark, n):
    check(spark, documents(spark), n)


def test_clashing_names_and_no_rows(spark):
    check(spark, clashing(spark), 2)
    assert minhash.near_duplicates(nothing(spark)).count() == 0


def test_chains_and_hubs(spark, monkeypatch):
    """Copies of one text that differ from it by more than from each other's neighbours, in small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(5)
    base = prose(9, 150, 5000).split()
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randrange(16)):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    chain = list(base[:100])
    for i in range(120, 160):
        chain[(i * 2) % 100] = f"c{i}"
        rows.append((i, " ".join(chain)))
    rng.shuffle(rows)
    check(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), 2)


def test_groups_are_bounded_and_hold_all_pairs(spark):
    """One bucket of many small components, one with a large component beside them, one of two classes."""
    roots = [(1, i, i - i % 2) for i in range(3000)]
    roots += [(2, i, 0 if i < 700 else i - i % 3) for i in range(1900)] + [(3, 1, 1), (3, 2, 2)]
    members = spark.createDataFrame([(b, 0, i, r) for b, i, r in roots], "bucket bigint, band int, doc_id bigint, root bigint")
    groups = {}
    for r in minhash._block_pairs(members).collect():
        groups.setdefault((r.bucket, r.band, r.kind, r.low, r.high), []).append(r)
    assert max(map(len, groups.values())) <= 2 * minhash.BLOCK
    met = {1: set(), 2: set(), 3: set()}
    for key, rows in groups.items():
        one = len({r.block for r in rows}) == 1
        ids = [(r.doc_id, r.root, r.block) for r in rows]
        met[key[0]] |= {(i, j) for i, x, k in ids for j, y, m in ids if i < j and x != y and (one or k != m)}
    for bucket, pairs in met.items():
        own = [(i, r) for b, i, r in roots if b == bucket]
        assert pairs == {(i, j) for i, x in own for j, y in own if i < j and x != y}


def test_many_small_components_in_one_bucket(spark, monkeypatch):
    """A template that all documents share, in pairs that are similar, each pair too far from the next."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    template, rows = prose(11, 100, 5000).split(), []
    for i in range(60):
        own = prose(100 + i, 24, 10**6).split()
        rows += [(2 * i, " ".join(template + own)), (2 * i + 1, " ".join(template + own[:-1] + [f"y{i}"]))]
    check(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), 2)


def test_pruning_bounds_follow_the_posterior():
    steps = minhash.Settings().least_matches()
    assert [m for m, _ in steps] == [32, 64, 96, 128, 160, 192]
    assert all(0 < k < 0.8 * m for m, k in steps)
    assert [k / m for m, k in steps] == sorted(k / m for m, k in steps)


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(250)]
    pairs += [(5, 5), (None, 7), pairs[0]]
    found = components(spark.createDataFrame(pairs, "x bigint, y bigint")).collect()
    root = {i: i for p in pairs for i in p if i is not None}
    for _ in range(len(root)):
        before = dict(root)
        for x, y in pairs:
            if x is not None and y is not None:
                root[x] = root[y] = min(root[x], root[y])
        if root == before:
            break
    nodes = {i for x, y in pairs if x is not None and y is not None and x != y for i in (x, y)}
    assert {r.node: r.root for r in found} == {i: root[i] for i in nodes} and len(found) == len(nodes)
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0
