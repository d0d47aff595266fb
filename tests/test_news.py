"""The shared-term shortcut of the news search returns exactly the brute-force top-k."""

import os

import pytest

from vesselrisk.plans import news
from vesselrisk.sources.fixtures import Fixtures
from vesselrisk.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_shared_term_split_is_exact(spark):
    vessels = Fixtures(spark, SF).vessel_meta.select("mmsi", "name", "flag")
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    brute = news.news_context(vessels, docs, shared_from=10**9)
    split = news.news_context(vessels, docs, shared_from=1)
    usual = news.news_context(vessels, docs)
    key = lambda r: (r["mmsi"], r["rank"], r["doc_id"], round(r["score"], 9))
    b = sorted(map(key, brute.collect()))
    s = sorted(map(key, split.collect()))
    assert b and b == s == sorted(map(key, usual.collect()))


def test_terms_without_a_posting_make_no_set_of_their_own(spark, monkeypatch):
    """names that no document has do not multiply the postings of a flag, and words of texts meet a broadcast table."""
    vessels = spark.createDataFrame([(f"v{i}", f"Ship{i // 2}", "PA") for i in range(20)], "mmsi string, name string, flag string")
    docs = spark.createDataFrame([(i, "pa " * (i + 1) + "harbour") for i in range(5)], "doc_id long, text string")
    sets = []
    top = news.top_k_per_group
    monkeypatch.setattr(news, "top_k_per_group", lambda df, group, *a: sets.append(df) or top(df, group, *a))
    got = news.news_context(vessels, docs).collect()
    assert sorted((r.mmsi, r.doc_id) for r in got) == sorted((f"v{i}", d) for i in range(20) for d in (2, 3, 4))
    assert sets[0].select("sig").distinct().count() == 1
    scores = news.doc_term_scores(docs, spark.createDataFrame([("pa",), ("none",)], "term string"))
    assert "strategy=broadcast" in scores._jdf.queryExecution().analyzed().toString() and scores.count() == 5
