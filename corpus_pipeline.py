"""The corpus pipeline: documents through quality rules, near-dedup, decontamination, mixing and token-ID output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselrisk.llm import decontamination, mixing, quality_rules, simhash, tokens
from vesselrisk.llm.common import pack, read_table, shared_path, unpack
from vesselrisk.llm.queries import SOURCE_WEIGHTS, tokenizer_path
from vesselrisk.session import ensure_conf


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    rows = pack(docs).select("row", "row.text", "row.lang")
    return unpack(quality_rules.judge(rows, keep=["row"]).where("kept"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    rows = pack(docs).select("row", "row.text")
    flagged = decontamination.flag(rows, read_table(spark, sf_dir, "benchmark"), keep=["row"])
    return unpack(flagged.where(~F.col("contaminated")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at a source's cut goes in whole if that comes nearer to the target."""
    rows = pack(docs).select("row", "row.doc_id", "row.text", "row.source")
    mixed = mixing.mix(rows, SOURCE_WEIGHTS, max_epochs=3)
    times = F.col("epochs") + F.when(F.col("last") * 2 > F.col("size"), 1).otherwise(0)
    repeated = mixed.where(times > 0).select("row", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return unpack(repeated, docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document of the mix: its place and check sum in the token files."""
    path = tokens.write_tokens(docs.select("doc_id", "text"), tokenizer_path())
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def _on_ready_session(stage):
    """A stage may be called on its own, so it sees to the session settings and the shipped package itself."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ensure_conf(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _on_ready_session(quality)),
    ("SimHash near-dedup", _on_ready_session(near_dedup)),
    ("benchmark decontamination", _on_ready_session(decontaminate)),
    ("mixing sources", _on_ready_session(mix)),
    ("token-ID output", _on_ready_session(token_ids)),
]
ORACLE_SQL = None  # fingerprints and tokens have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
