"""The source divergence audit against plain Python."""

import random

import numpy as np

from indexforge.llm import divergence as dv
from tests.llm import brute
from tests.llm.conftest import EDGE

SCHEMA = "text string, lang string, source string"


def got(df):
    return sorted(tuple(r) for r in df.collect())


def rows(seed=1):
    r, out = random.Random(seed), [(None, None, None), ("", "", "s1"), ("12 34", "xx", "a"), ("!", "xx", "b"), (None, "yy", None)]
    words = ["the", "The", "straße", "漢字", "é", "a-b", "x1y", "🙂", *(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200))]
    for k in range(400):
        lang, source = r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", "S1", None, "big", "big", "big"])
        out.append((" ".join(r.choice(words[:20 + 60 * (source == "big") + 4 * k % 100]) for _ in range(r.randrange(0, 60))), lang, source))
    return out


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    want = sorted(brute.divergence(data))
    assert {w[2] for w in want} == {"pair", "term"} and any(w[:3] == ("xx", "a", "pair") for w in want)
    assert got(dv.divergence(df)) == want
    # many segments and blocks of sources
    assert got(dv.divergence(df, segment=5, block=2)) == want
    assert got(dv.divergence(df, min_docs=1, top=3)) == sorted(brute.divergence(data, 1, 3))


def test_edges(spark, edge):
    docs = [(t, "en" if d % 2 else None, None if d == 3 else f"src{d % 3}") for d, t in EDGE]
    df = spark.createDataFrame([(*x, 1, "v", 0) for x in docs], SCHEMA + ", n int, term string, total int")
    assert got(dv.divergence(df, min_docs=2)) == sorted(brute.divergence(docs, 2))
    assert got(dv.divergence(df.unionAll(df), min_docs=2)) == sorted(brute.divergence(docs * 2, 2))
    assert dv.divergence(df.limit(0)).count() == 0
    # no kept term at all: pairs at 0
    assert {r[2:5:2] for r in got(dv.divergence(df))} == {("pair", 0)}


def test_small_pieces(monkeypatch):
    """Terms are not cut where a piece of text ends."""
    for text in (" ".join("ab cdé fgh x" * k for k in range(9)), "x" * 50, "1" * 50, "é" * 33 + " z"):
        for piece in (1, 3, 8, 1000):
            monkeypatch.setattr(dv, "PIECE", piece)
            found = [w.decode() for part in dv._terms(text.encode()) for w in part]
            assert found == [w for w in text.replace("1", " ").split()]


def test_equal_subtrees_share_nodes_and_prices():
    r = np.random.default_rng(0)
    leaves = np.zeros((6, 64), np.int64)
    leaves[:, :8] = r.integers(0, 3, (6, 8))
    leaves[3] = leaves[2]
    leaves[:, 60:] = -1
    roots, levels, counts = dv.consed(leaves)
    assert roots[2] == roots[3] and len(set(roots)) == 5
    assert sum(len(left) for left, _ in levels) < 6 * 63 / 2  # nodes of six unshared trees
    totals = leaves[:, :60].sum(axis=1) + 5 * 60
    p = [dv.shares(x[:60], t) for x, t in zip(leaves, totals)]
    for k in range(6):
        value = dv.prices(roots[k], roots, levels, counts, totals[k], totals)
        assert value.tolist() == [np.abs(p[k] - q).sum() for q in p]


def test_shares_are_exact():
    r = np.random.default_rng(2)
    n = r.integers(0, 9 * 10 ** 14, 500)
    total = n + r.integers(5, 9 * 10 ** 14, 500)
    assert dv.shares(n, total).tolist() == [1 + 10 ** 9 * (a + 5) // b for a, b in zip(n.tolist(), total.tolist())]
