"""Queries of this subpackage against their DuckDB SQL, and the whole pipeline against its parts."""

import os
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "scripts"))
import corpus_pipeline  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from test_dedup import plain_fingerprint, plain_groups, plain_hits  # noqa: E402

from vesselrisk.llm import mixing, quality_rules  # noqa: E402
from vesselrisk.llm.common import checkpoint_dir  # noqa: E402
from vesselrisk.llm.queries import ORACLE, QUERIES, SOURCE_WEIGHTS  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(con.execute(ORACLE[name]).df())


def test_quality_stage_writes_a_text_once(spark):
    """The counts of the quality rules are written beside one copy of the document, not two."""
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("counted-*"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() > 0
    (counted,) = set(folder.glob("counted-*")) - before
    assert spark.read.parquet(str(counted)).schema.simpleString().count("text:") == 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r for r in quality_rules.judge(docs).where("kept").collect()}
    ids = sorted(kept)
    groups = plain_groups(ids, [plain_fingerprint(kept[d].text) for d in ids])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [d for d, g in zip(ids, groups) if d == g and not plain_hits(kept[d].text, items)[4]]
    stay = spark.createDataFrame([(d, kept[d].text, kept[d].source) for d in clean], "doc_id long, text string, source string")
    want = []
    for r in mixing.mix(stay, SOURCE_WEIGHTS).collect():
        want += [r.doc_id] * (r.epochs + (2 * r["last"] > r["size"]))
    got = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(want)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
