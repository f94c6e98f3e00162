"""Repeated word windows against plain Python."""

import random

import numpy as np
import pytest

from indexforge.llm import doubling_dedup as dd
from tests.llm import brute
from tests.llm.conftest import EDGE

NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256")


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def texts(seed=3):
    """Shared passages cut anywhere, periodic texts, windows at both ends, copies and other white space."""
    r, out = random.Random(seed), []
    word = lambda: "".join(r.choice("abcé") for _ in range(r.randrange(1, 4)))
    passages = [[word() for _ in range(r.randrange(30, 120))] for _ in range(10)]
    for _ in range(80):
        parts = []
        for _ in range(r.randrange(1, 4)):
            parts += [word() for _ in range(r.randrange(0, 50))]
            p = r.choice(passages)
            a = r.randrange(len(p))
            parts += p[a:a + r.randrange(20, 80)]
        out.append(" ".join(parts))
    one = " ".join(passages[0][:30] + passages[1][:5])
    out += [one, one.replace(" ", "\n"), "x " * 35, "y " * 36, "a b " * 40, out[3], out[3], out[4] + " tail",
            "\x0b ".join(["head", *out[5].split()]), " ".join(["Word"] + passages[2][:34]), " ".join(passages[2][:34])]
    r.shuffle(out)
    return list(enumerate(out))


def test_edges(spark, edge):
    want = sorted(brute.repeated_windows(EDGE), key=repr)
    out = dd.remove_repeated_windows(edge)
    assert got(out) == want
    assert all(r.kept_sha256 == brute.sha(r.kept) for r in out.collect())
    assert dd.remove_repeated_windows(edge.limit(0)).count() == 0
    # every row is a document: repeated rows and null ids remove each other
    rows = [*EDGE, *EDGE[9:12], (None, EDGE[11][1]), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(dd.remove_repeated_windows(df)) == sorted(brute.repeated_windows(rows), key=repr)


@pytest.mark.parametrize("n, least", [(35, 8), (35, 35), (10, 2), (2, 1)])
def test_shared_passages(spark, n, least):
    docs = texts()
    want = sorted(brute.repeated_windows(docs, n), key=repr)
    assert sum(w[2] > 0 for w in want) > 30
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(dd.remove_repeated_windows(df, n=n, least=least)) == want


def test_small_pieces(spark, monkeypatch):
    """Slices, hash pieces, folds and remembered texts that end everywhere change nothing."""
    docs = texts(5)
    monkeypatch.setattr(dd, "PIECE", 64)
    monkeypatch.setattr(dd, "SLICE_BYTES", 300)
    monkeypatch.setattr(dd, "FLUSH_ROWS", 40)
    monkeypatch.setattr(dd, "REMEMBER", 1)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert got(dd.remove_repeated_windows(df)) == sorted(brute.repeated_windows(docs), key=repr)


def test_levels_double():
    assert dd.level_lengths(35) == [9, 18, 35]
    for n in range(2, 300):
        lengths = dd.level_lengths(n)
        assert all(b in (2 * a, 2 * a - 1) for a, b in zip(lengths, lengths[1:]))


def test_representatives_depend_on_the_window_only():
    r = np.random.default_rng(1)
    w = r.integers(0, 5, 400).astype(np.uint64)
    h, _, s, e = dd.represented(w, np.arange(400 - 35 + 1), 9, 35)
    of = {}
    for x, a, b in zip(h, s, e):
        of |= dict.fromkeys(range(a, b), x)
    assert len(of) == 366 and len(h) < 100
    for p in range(366):
        alone = dd.represented(w[p:p + 35], np.arange(1), 9, 35)[0]
        assert alone.tolist() == [of[p]]
