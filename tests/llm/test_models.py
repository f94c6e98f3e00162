"""Operators 1 and 4: held-out accuracy, the network's parts, and the grammar."""

import zlib

import numpy as np

from indexforge.llm import quality_cnn, queries, toxicity
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n1, n0 = y.sum(), len(y) - y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / n1 / n0


def held_out(spark, query, label, folds, fold):
    rows = {r.doc_id: r for r in query(spark, SF).collect()}
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == n
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % folds == fold) and 0 <= r.score <= 1
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label).collect()
    own = [(rows[d], y) for d, y in labels if rows[d].held_out]
    return own, np.array([r.score for r, _ in own]), np.array([y for _, y in own])


def test_quality_held_out(spark):
    own, score, y = held_out(spark, queries.op1_quality_classifier, "quality", 5, 0)
    assert all(r.predicted == (r.score >= 0.3) for r, _ in own)
    assert auc(score, y) > 0.9
    assert (score[y == 1] >= 0.3).mean() > 0.95


def test_quality_refuses_poor_texts(spark):
    """Held-out poor documents of sf0.1 are refused and good ones kept."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    net = quality_cnn.train(docs, labels)
    rows = docs.join(labels.select("doc_id", "quality"), "doc_id").select("doc_id", "text", "quality").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    score, y = net.scores([r.text for r in rows]), np.array([r.quality for r in rows])
    assert (score[y == 0] < 0.3).mean() >= 0.9 and (score[y == 1] >= 0.3).mean() >= 0.98


def test_quality_forward_pass_matches_plain_loops():
    net, text = quality_cnn.ByteConv(3), "plain words, then la la la la la and more é words. " * 14
    net.bias += 0.3
    symbols, best = quality_cnn.symbols(text).tolist(), []
    for start in range(0, max(1, len(symbols) - 64), quality_cnn.STRIDE):
        chunk = (symbols[start:start + quality_cnn.CHUNK] + [quality_cnn.PAD] * quality_cnn.CHUNK)[:quality_cnn.CHUNK]
        best.append([max(sum(float(net.table[j, chunk[p + j], f]) for j in range(quality_cnn.WIDTH))
                         for p in range(quality_cnn.CHUNK - quality_cnn.WIDTH + 1)) + float(net.bias[f])
                     for f in range(quality_cnn.FILTERS)])
    pooled = np.maximum(np.array(best), 0)
    z = np.concatenate([pooled.max(axis=0), pooled.mean(axis=0)]) @ net.top + net.offset[0]
    assert len(best) == len(quality_cnn.chunks(text)) > 1
    assert abs(net.scores([text])[0] - 1 / (1 + np.exp(-z))) < 2e-4


def test_quality_learns_from_every_chunk_whatever_is_passed_at_once():
    r = np.random.default_rng(5)
    prose = lambda n: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(n))
    sample = [(prose(40 + 900 * (i % 9 == 0)) + (" | | |" if i % 2 else ""), i % 2) for i in range(60)]
    texts = [t for t, _ in sample]
    whole, parts = quality_cnn.fit(sample, epochs=2), quality_cnn.fit(sample, epochs=2, at_once=7)
    assert np.allclose(whole.scores(texts), parts.scores(texts), atol=5e-3)


def test_quality_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        t = "".join(chr(97 + i * 7 % 26) for i in range(n))
        x = quality_cnn.chunks(t)
        s = quality_cnn.symbols(t)
        back = np.full((len(x) - 1) * quality_cnn.STRIDE + quality_cnn.CHUNK, quality_cnn.PAD)
        for i, c in enumerate(x):
            back[i * quality_cnn.STRIDE:i * quality_cnn.STRIDE + quality_cnn.CHUNK] = c
        assert (back[:n] == s).all() and (back[n:] == quality_cnn.PAD).all()
        assert len(x) == 1 or back[n - 1 - 64:].size  # the last chunk is not padding alone
    assert (quality_cnn.symbols("la " * 30)[12:] >= 256).all() and (quality_cnn.symbols("plain words here") < 256).all()


def test_quality_scores_do_not_depend_on_neighbours(spark, edge):
    net = quality_cnn.ByteConv(1)
    texts = [t for _, t in EDGE]
    alone = np.concatenate([net.scores([t]) for t in texts])
    assert np.allclose(net.scores(texts), alone, atol=2e-4)
    assert net.scores([]).tolist() == []
    got = {r.doc_id: r.score for r in quality_cnn.score_quality(edge, net).collect()}
    assert np.allclose([got[d] for d, _ in EDGE], alone, atol=2e-4)
    kept = quality_cnn.filter_quality(edge, net, least=float(np.median(alone)) - 1e-5)
    assert kept.schema == edge.schema
    assert {r.doc_id for r in kept.collect()} == {d for (d, _), s in zip(EDGE, alone, strict=True)
                                                 if s >= np.median(alone) - 1e-5}
    assert quality_cnn.fit([]).scores(["a", None]).tolist() == [0.5, 0.5]
    assert (quality_cnn.fit([("a", 1)]).scores(["a", ""]) > 0.9).all()


def test_quality_gradient_learns():
    r = np.random.default_rng(0)
    prose = lambda: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(80)) + "."
    sample = [(prose(), 1) if i % 2 else (prose().replace(" ", " | "), 0) for i in range(120)]
    net = quality_cnn.fit(sample, epochs=8)
    score = net.scores([t for t, _ in sample])
    assert auc(score, np.array([y for _, y in sample])) > 0.99


def test_toxicity_held_out(spark):
    own, score, y = held_out(spark, queries.op4_toxicity, "toxic", 3, 1)
    assert all(r.predicted == (r.score >= 0.7) for r, _ in own)
    assert auc(score, y) > 0.8  # few labels here; the larger table is below
    assert (score[y == 0] >= 0.7).mean() < 0.05


def test_toxicity_recall_on_the_larger_table(spark):
    """Held-out toxic documents of sf0.1: nine in ten are caught at 0.7, with under 2% false hits."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = docs.join(labels.select("doc_id", "toxic"), "doc_id").select("doc_id", "text", "toxic").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    score, y = model.scores([r.text for r in rows]), np.array([r.toxic for r in rows])
    assert (score[y == 1] >= 0.7).mean() >= 0.9 and (score[y == 0] >= 0.7).mean() < 0.02


def test_composed_grammar():
    read = lambda s: [out for out, _ in toxicity.GRAMMAR.read(s.split())]
    assert read("o I o") == ["o", "I", "o"]
    assert read("T o I") == ["o", "o", "It"]
    assert read("T o o o I")[-1] == "I"
    assert read("T N o I")[-1] == "Itn"
    assert read("R o o o o o o I")[-1] == "Ir"
    assert read("R T H")[-1] == "Htr"
    weight = dict(zip(["I", "It", "In"], [sum(w for _, w in toxicity.GRAMMAR.read(s.split())) for s in
                                          ("o I", "T I", "N I")], strict=True))
    assert weight["It"] > weight["I"] > weight["In"]


def test_toxicity_clauses():
    sample = [(f"the w{i} x{i} y{i} came. You are a grobian{i % 3} today", 1) for i in range(60)]
    sample += [(f"the w{i} x{i} y{i} came. You are a friend{i % 3} today", 0) for i in range(120)]
    m = toxicity.fit(sample)
    assert any(w.startswith("grob") for w in {**m.lexicon.stems, **m.lexicon.words})
    plain, insult, negated, reported = m.scores(
        ["a friend came", "you are a grobian1", "you are not a grobian1", "he said one was a grobian1"])
    assert insult > 0.7 > plain and insult > negated and insult > reported
    # a clause ends the scope
    assert abs(m.scores(["he said so. you are a grobian1"])[0] - insult) < 1e-9
    assert list(m.lexicon.clauses("one. you grobian1, hm! and no")) == [" you grobian1, hm"]
    assert m.scores([None, "", "?"]).std() < 1e-12
    assert toxicity.fit([]).scores(["idiot", None]).tolist() == [0.5, 0.5]


def _off(opener, inputs):
    """A transducer that marks nothing."""
    return toxicity.Transducer({(0, x): (0, "o" if x == opener else x, 0.0) for x in inputs})


def test_removing_a_transducer_changes_the_scores(monkeypatch):
    sample = [(f"x{i} y{i}. you are a grobian{i % 3} now", 1) for i in range(90)]
    sample += [(f"x{i} y{i}. you are a friend{i % 3} now", 0) for i in range(150)]
    texts = ["one grobian1 here", "you grobian1 here", "not one grobian1 here", "he said one is grobian1"]
    bare, targets, negated = toxicity._BARE, toxicity._TARGETED, toxicity._NEGATED
    off = {"target": _off("T", [*bare, "T", "N", "R", "o"]), "negation": _off("N", [*targets, "N", "R", "o"]),
           "report": _off("R", [*negated, "R", "o"])}
    on = {"target": toxicity.TARGET, "negation": toxicity.NEGATION, "report": toxicity.REPORT}

    def scores(**parts):
        p = on | parts
        monkeypatch.setattr(toxicity, "GRAMMAR", p["target"].then(p["negation"]).then(p["report"]))
        return toxicity.fit(sample).scores(texts)

    plain, aimed, denied, told = whole = scores()
    assert aimed > plain > denied and plain > told
    for k, part in enumerate(off, 1):
        less = scores(**{part: off[part]})
        assert abs(np.log(less[k] / (1 - less[k])) - np.log(whole[k] / (1 - whole[k]))) > 0.1, part


def test_toxicity_scores_match_plain_reading():
    """Features and score of single clauses, spelt out."""
    lexicon = toxicity.Lexicon({"grobian": 1.5}, {"depp": 0.5, "trott": 0.25}, {"depp"})
    m = toxicity.Model(lexicon, np.arange(1, toxicity.N_FEATURES + 1) / 10, -1.0)

    def expect(total, top, n, hits, sums):
        x = [np.log1p(total), top, np.log1p(n), n > 0, hits > 1,
             *[np.log1p(max(0.0, sums.get(k, 0.0))) for k in "ItnrH"]]
        return 1 / (1 + np.exp(-(np.dot(x, m.w) - 1.0)))

    cases = {"A grobian came": (1.5, 1.5, 1, 1, {"I": 1.5}), "you are a grobian": (2.25, 2.25, 1, 1, {"t": 2.25}),
             "no grobian. A grobian": (0.75 + 1.5, 1.5, 2, 2, {"n": 0.75, "I": 1.5}), "one deppen": (0, 0, 0, 0, {}),
             "deppen, deppert": (1.0, 1.0, 1, 2, {"I": 1.0}),
             "one trottel": (0.25, 0.25, 1, 1, {"I": 0.25}), "we kill": (1.0, 1.0, 1, 0, {"H": 1.0}), "": (0, 0, 0, 0, {})}
    for text, want in cases.items():
        assert abs(m.scores([text])[0] - expect(*want)) < 1e-12, text


def test_rows_without_an_id_are_not_held_out(spark):
    got = queries._judged(spark.createDataFrame([(None, 0.9), (0, 0.1)], "doc_id long, score double"), 5, 0, 0.3)
    assert {r.doc_id: (r.held_out, r.predicted) for r in got.collect()} == {
        None: (False, 1), 0: (zlib.crc32(b"0") % 5 == 0, 0)}


def test_toxicity_edges(spark, edge):
    model = toxicity.fit([])
    assert toxicity.score_toxicity(edge, model).count() == len(EDGE)
