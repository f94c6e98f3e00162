"""The registered queries against their SQL, and the native operators' plans."""

import re

import pytest

from indexforge.llm import decontam, line_dedup, line_rules, secrets, url_markov
from indexforge.llm.queries import QUERIES
from indexforge.llm.sql import ORACLE
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    ok, why = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert ok, why


def test_native_operators_run_no_python(spark):
    docs, bench, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "pages"))
    for df in (secrets.scan_secrets(docs), secrets.drawn_strings(spark), secrets.ordinary_identifiers(docs.selectExpr(
            "doc_id AS key", "text", "cast(array() as array<struct<s:int,e:int,k:int,v:string>>) AS base"), 16),
            decontam.find_hits(docs, bench), decontam.windows(bench), line_rules.quality_rules(docs),
            url_markov.filter_urls(pages), line_dedup.drop_boilerplate(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)
