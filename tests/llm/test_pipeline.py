"""The pipeline's stages against plain Python versions, each on its own input."""

from collections import Counter

import corpus_pipeline as cp
from indexforge.llm import curriculum, quality_cnn
from indexforge.llm.sql import ORACLE
from tests.compare import duck
from tests.llm import brute
from tests.llm.conftest import EDGE, PROSE

SF = "/root/testdata/sf0.01"


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_copies", "decontamination", "mix"]
    for name, stage in cp.STAGES:
        path = scratch(name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()}
        if name != "mix":
            assert out.columns == docs.columns and after.keys() <= before.keys()
        if name == "quality":
            gone = before.keys() - after.keys()
            assert sum(labels.get(d) == 0 for d in gone) > 10
            assert sum(labels.get(d) == 1 for d in gone) <= 0.02 * len(before)
        elif name == "line_dedup":
            assert after.keys() == before.keys()
            for d, t in before.items():
                lines = iter(t.split("\n"))
                assert after[d].text == t or not after[d].text or all(x in lines for x in after[d].text.split("\n"))
        elif name == "near_copies":
            assert after.keys() == {d for d, _, c in brute.near_components(list(before.items())) if d == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert after.keys() == {r[0] for r in brute.decontam_rows(list(before.items()), items) if not r[-1]}
        else:
            mixed = curriculum.mix_sources(docs).collect()
            assert out.columns == [*docs.columns, "__copy", "__position"]
            assert sorted((r.doc_id, r["__copy"], r["__position"]) for r in out.collect()) == sorted(
                (r.doc_id, k, p) for r in mixed for k, p in enumerate(r.positions))
            assert all(after[d].text == before[d] for d in after)
            size, source = {d: len(brute.WORD.findall(t)) for d, t in before.items()}, {r.doc_id: r.source for r in docs.collect()}
            taken, total = Counter(), Counter()
            for r in out.collect():
                taken[source[r.doc_id]] += size[r.doc_id]
            for d, n in size.items():
                total[source[d]] += n
            want = brute.targets(dict(total))
            assert all(abs(taken[x] - want[x]) <= max(n for d, n in size.items() if source[d] == x) for x in want)
        docs = out
    run = cp.run(spark, SF)
    order = [r["__position"] for r in run.select("__position").collect()]
    assert order == sorted(order)
    assert sorted(run.select("doc_id", "__copy").collect()) == sorted(docs.select("doc_id", "__copy").collect())


def test_stages_on_edges(spark, tmp_path):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing names and empty tables."""
    texts = [*EDGE, (5, PROSE), (None, PROSE), (None, None), (9, "another text under an old id"), (50, "x " * 30000)]
    rows = [(d, t, None if i % 3 else "en", None if i % 4 == 0 else f"src{i % 2}", 1, 7, "k", 2, "h") for i, (d, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key int, h string, n int, id string"
    docs = spark.createDataFrame(rows, schema).coalesce(2)
    labels = spark.createDataFrame([(d, d % 2, 0) for d, _ in EDGE], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, PROSE), (None, "one"), (2, None)], "item_id long, text string")
    for name, full in (("full", True), ("empty", False)):
        folder = str(tmp_path / name)
        labels.limit(21 if full else 0).write.parquet(f"{folder}/labels.parquet")
        bench.limit(3 if full else 0).write.parquet(f"{folder}/benchmark.parquet")
        for stage, f in cp.STAGES:
            here = docs if full else docs.limit(0)
            out = f(spark, here, folder)
            got = out.collect()
            if not full:
                assert got == [] and out.columns[:len(docs.columns)] == docs.columns
                continue
            assert out.columns[:len(docs.columns)] == docs.columns and len(got) > 0
            assert all((r.n_chars, r.key, r.h, r.n, r.id) == (1, 7, "k", 2, "h") for r in got)
            if stage == "decontamination":
                items = [(1, PROSE), (None, "one"), (2, None)]
                clean = [t for d, t in texts if not brute.decontam_rows([(0, t)], items)[0][-1]]
                assert sorted(r.text or "" for r in got) == sorted(t or "" for t in clean)
            if stage == "near_copies":
                assert {r.doc_id for r in got} >= {0, 1, 2, None, 5} and not {6, 16} & {r.doc_id for r in got}
            if stage == "mix":
                words = Counter(r.text for r in got)
                assert all(n <= 2 * sum(t == x for _, t in texts) for x, n in words.items())
                assert {r.doc_id for r in got} <= {d for d, t in texts if brute.WORD.search(t or "")}


def test_quality_stage_scores_each_document(spark):
    """The stage keeps what the network of the same labels scores 0.3 or more."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    net = quality_cnn.train(docs, labels)
    kept = {r.doc_id for r in cp.STAGES[0][1](spark, docs, "/root/testdata/sf0.001").collect()}
    assert kept == {r.doc_id for r in docs.collect() if net.scores([r.text])[0] >= 0.3 - 1e-9}


def test_line_stage_matches_sql(spark):
    """The stage's texts are those of the operator's SQL (op10)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: brute.sha(r.text) for r in cp.STAGES[1][1](spark, docs, SF).collect()}
    want = duck(SF).execute(ORACLE["op10_line_dedup"])
    at = [c[0] for c in want.description]
    assert got == {r[at.index("doc_id")]: r[at.index("kept_sha256")] for r in want.fetchall()}
