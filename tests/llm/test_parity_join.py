"""The parity-sketch join against all pairs in plain Python, and its pigeonhole on its own."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa

from indexforge.llm import parity_join as pj
from indexforge.llm.shingles import shingle_sets
from tests.llm import brute
from tests.llm.conftest import EDGE, PROSE


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def near_texts(seed=3):
    """Groups of near copies with few to many edits, chains, shared passages and common lines."""
    r, out = random.Random(seed), []
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = [r.choice(vocabulary) for _ in range(70)]
    for size in (6, 9, 14, 30, 80, 300, 900):
        for group in range(4):
            words = [r.choice(vocabulary) for _ in range(size)]
            if group == 3:
                words[size // 2:size // 2] = passage
            for copy in range(6):
                own = list(words)
                for _ in range(r.randrange(0, 2 + size // 40)):
                    own[r.randrange(len(own))] = r.choice(vocabulary)
                if copy == 5:  # a chain: every copy is an edit of the one before it
                    words = own
                out.append(" ".join(own))
    chain = [r.choice(vocabulary) for _ in range(120)]
    for k in range(25):
        chain[(k * 7) % 120] = f"c{k}"
        out.append(" ".join(chain))
    for k in range(60):  # a long shared passage in texts that are not similar
        out.append(" ".join(passage + [r.choice(vocabulary) for _ in range(r.randrange(20, 90))]))
    return list(enumerate(out, 100))


def test_edges(spark, edge):
    assert got(pj.near_components(edge)) == sorted(brute.near_components(EDGE))
    assert pj.near_components(edge.limit(0)).count() == 0
    kept = pj.drop_near_copies(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, c in brute.near_components(EDGE) if d == c]
    twice = got(pj.near_components(edge.unionAll(edge)))
    assert twice == sorted(brute.near_components(EDGE))


def test_tables_and_planted_groups(spark, sample):
    docs = near_texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = sorted(brute.near_components(docs))
    assert got(pj.near_components(df)) == want
    assert got(pj.near_components(df, max_broadcast_rows=0)) == want
    assert got(pj.near_components(df.coalesce(2), split=2)) == want  # hot cells are split off in the map tasks
    assert got(pj.near_components(sample[1])) == sorted(brute.near_components(sample[0]))


def test_similar_sets_share_a_cell():
    """Every pair at the threshold meets in a cell, whatever its size."""
    r, bands = np.random.default_rng(5), pj.Bands()
    for n in [*range(1, 60), 100, 250, 999, 4000]:
        for _ in range(6):
            a = np.unique(r.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2))
            # drop and add as many as a similarity of 0.8 allows
            drop = int(r.integers(0, n // 5 + 1))
            add = 0
            while 100 * (len(a) - drop) >= 80 * (len(a) + add + 1):
                add += 1
            b = np.unique(np.concatenate([r.permutation(a)[drop:], r.integers(0, 2 ** 63, add, dtype=np.uint64)]))
            assert pj.similar(a, b, 80, 100)
            keys = []
            for s in (a, b):
                own = bands.of(len(s))
                keys.append({int(x) for w in (own, own + 1) for x in pj.cells(s, w, *bands.shape(w))})
            assert keys[0] & keys[1], (n, drop, add)
            pair = [np.frombuffer(pj.bit_sketch(s), np.uint64) for s in (a, b)]
            assert pj.sketch_distance(*pair) <= len(np.setxor1d(a, b))
    big = np.unique(r.integers(0, 2 ** 63, 5000, dtype=np.uint64))
    x, y = (np.frombuffer(pj.bit_sketch(s), np.uint64) for s in (big, big[:300]))
    assert len(x) > len(y) and pj.sketch_distance(x, y) == pj.sketch_distance(y, x) <= 4700


def test_shingles_match_plain_python():
    texts = [t for _, t in EDGE] + [None, "é x y z w v", " a  b\x0bc d e f "]
    for t, s in zip(texts, shingle_sets(pa.array(texts)), strict=True):
        assert len(s) == len(brute.shingles(t))
    a, b = shingle_sets(pa.array(["A b C d E f", "a B c D e F"]))
    assert (a == b).all()


def test_large_open_cell_is_dealt_to_blocks(spark):
    """No group holds a whole large cell, and every two of its texts meet in exactly one group."""
    rows = spark.range(1000).selectExpr("7L AS cell", "1000L AS k", "id AS m").union(
        spark.range(3).selectExpr("8L AS cell", "3L AS k", "id AS m"))
    groups = defaultdict(list)
    for r in pj._spread(rows, 100).collect():
        groups[r.cell, r.i, r.j].append((r.m, r.blk))
    assert max(map(len, groups.values())) < 350 and len(groups) == 55 + 1
    met = Counter()
    for (cell, i, j), x in groups.items():
        met.update((cell, min(a, b), max(a, b)) for (a, p), (b, q) in combinations(x, 2) if i == j or p != q)
    assert set(met.values()) == {1} and len(met) == 1000 * 999 // 2 + 3


def test_blocks_of_an_open_cell_find_the_same_pairs(spark):
    """Dealt to blocks or not, a cell's rows give the pairs of other components that sketches allow."""
    draw = random.Random(5)
    sets = [np.unique(np.array([draw.getrandbits(64) for _ in range(60)], np.uint64)) for _ in range(20)]
    sets += [np.unique(np.append(s[2:], np.uint64(draw.getrandbits(64)))) for s in sets]
    rows = spark.createDataFrame(
        [(1, len(sets), i, i, len(s), bytearray(pj.bit_sketch(s))) for i, s in enumerate(sets)],
        "cell long, k long, m long, cm long, n long, sketch binary")
    for most in (100, 4):
        dealt = pj._spread(rows, most).select("cell", "i", "j", "m", "cm", "n", "sketch", "blk")
        got = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "m").mapInArrow(
            pj._crossing(80, 100), "a long, b long").collect()
        assert sorted(map(tuple, got)) == [(i, i + 20) for i in range(20)]


def test_null_ids_are_passed_through(spark):
    rows = [(5, PROSE), (6, PROSE), (None, PROSE), (None, PROSE), (None, None), (7, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, r.n_shingles, r.component_id) for r in pj.near_components(df).collect()]
    assert sorted(x for x in out if x[0]) == sorted(brute.near_components([r for r in rows if r[0]]))
    assert [x for x in out if not x[0]] == [(None, 0, None)] * 3
    assert sorted(map(str, pj.drop_near_copies(df).select("doc_id", "text").collect())) == sorted(
        map(str, df.filter("doc_id is null or doc_id <> 6").collect()))
