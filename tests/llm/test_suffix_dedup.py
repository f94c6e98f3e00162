"""Repeated-substring dedup against plain Python."""

import random

import numpy as np

from indexforge.llm import suffix_dedup as sd
from tests.llm import brute
from tests.llm.conftest import EDGE, PROSE

NAMES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def got(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def texts(seed=2):
    """Copies, shared passages at many cuts, periodic runs and strings at either end of a text."""
    r, out = random.Random(seed), []
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(r.randrange(8, 60))) for _ in range(12)]
    for _ in range(60):
        parts = []
        for _ in range(r.randrange(1, 5)):
            parts.append(" ".join(word() for _ in range(r.randrange(0, 40))))
            p = r.choice(passages)
            a = r.randrange(len(p))
            parts.append(p[a:a + r.randrange(30, 200)])
        out.append("".join(parts))
    out += ["ab" * 90, "x" * 200, "x" * 55, out[3], out[3] + "tail", "head" + out[4], out[5][:49], out[5][:50]]
    r.shuffle(out)
    return list(enumerate(out))


def test_edges(spark, edge):
    assert got(sd.remove_repeats(edge)) == sorted(brute.repeats(EDGE))
    assert sd.remove_repeats(edge.limit(0)).count() == 0
    twice = edge.filter("doc_id in (11, 16)")
    assert got(sd.remove_repeats(twice.unionAll(twice))) == sorted(
        2 * brute.repeats([x for x in EDGE if x[0] in (11, 16)]))


def test_shared_passages(spark, sample):
    docs = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = sorted(brute.repeats(docs))
    assert sum(w[2] > 0 for w in want) > 30
    assert got(sd.remove_repeats(df)) == want
    # buckets too large to gather, and no broadcast
    assert got(sd.remove_repeats(df, max_bucket=0, max_broadcast_rows=0)) == want
    kept = {r.doc_id: r.kept for r in sd.remove_repeats(df).collect()}
    assert all(brute.sha(kept[d]) == h for d, _, n, _, h in want if n)
    assert got(sd.remove_repeats(sample[1])) == sorted(brute.repeats(sample[0]))


def test_anchors_depend_on_the_string_only():
    r = np.random.default_rng(4)
    for n in (24, 30, 50):
        b = r.integers(97, 100, 400).astype(np.uint8)
        at = set(sd.anchors(b, n)[0].tolist())
        for p in range(len(b) - n + 1):
            alone = sd.anchors(b[p:p + n], n)[0]
            assert len(alone) and all(p + a in at for a in alone.tolist())


def test_null_ids_lose_and_remove_nothing(spark):
    rows = [(5, PROSE), (6, "x " + PROSE), (7, PROSE), (None, PROSE), (None, "y " + PROSE), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r)[:5] for r in sd.remove_repeats(df).collect()]
    assert sorted(x for x in out if x[0]) == sorted(brute.repeats([r for r in rows if r[0]]))
    assert sorted(x for x in out if not x[0]) == sorted((None, len(t), 0, 0, brute.sha(t)) for d, t in rows if not d)
