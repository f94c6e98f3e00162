"""The conversation prefix trie against plain Python."""

import random

from indexforge.llm import prefix_trie as pt
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def want(rows):
    return sorted(brute.prefix_trie(rows), key=repr)


def conversations(seed=1):
    """Copies, shared openings, prefixes of one another, null and repeated turns, negative ids and gaps."""
    r, out = random.Random(seed), []
    turns = [("user", "hi"), ("user", "hello there you"), ("assistant", "one two three"), (None, None), ("user", ""),
             ("assistant", "é 漢字 x"), ("us", "erhi")]
    for c in [*range(-25, 90), 10 ** 12, 10 ** 12 + 3]:
        if c % 20 == 0 and r.random() < 0.3:
            continue  # no first conversation
        n, k = r.choice([1, 1, 2, 3, 4, 6]), r.choice([0, 1, 5])
        for t in range(n):
            out.append((c, None if t == 1 and k == 5 else t + k, *turns[r.randrange(2 if t < 2 else len(turns))]))
    out += [(7, 3, "user", "tie"), (7, 3, "user", "tie two"), (7, 3, "user", "tie"), (None, 1, "user", "nobody")]
    r.shuffle(out)
    return out


def test_matches_brute_force(spark, monkeypatch):
    for seed in range(3):
        rows = conversations(seed)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        w = want(rows)
        assert max(x[3] for x in w if x[1] > 1) > 5 and any(x[5] > x[4] for x in w)
        assert got(pt.prefix_trie(df)) == w
    monkeypatch.setattr(pt, "PIECE", 3)  # end lists of many pieces
    assert got(pt.prefix_trie(df)) == w


def test_edges(spark):
    one = [(40, None, None, None)]
    assert got(pt.prefix_trie(spark.createDataFrame(one, SCHEMA))) == want(one)
    # turnless after rebuilding: its only turn goes and there is no first conversation
    gone = [(c, 0, "user", "x y") for c in range(21, 40)]
    w = want(gone)
    assert any(x[1] == 0 and x[7] != brute.sha("") for x in w)
    assert got(pt.prefix_trie(spark.createDataFrame(gone, SCHEMA))) == w
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    long = [(c, t, "user", f"word {t} " + "x " * (t % 7)) for c in range(6) for t in range(300)]
    df = spark.createDataFrame(long, SCHEMA).selectExpr("*", "1 AS at", "'k' AS k1", "2 AS low", "text AS name")
    assert got(pt.prefix_trie(df)) == want(long)
    assert got(pt.prefix_trie(df.unionAll(df))) == want(long * 2)


def test_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(pt.prefix_trie(df)) == want([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
