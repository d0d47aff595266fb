"""The registered queries of this subpackage: thin digests of the operators' outputs, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    chosen_path,
    classifier,
    decontamination,
    html,
    importance,
    mixing,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    tokens,
    whitening,
)
from .common import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
SOURCE_WEIGHTS = [5.0, 2.0, 1.0]
N_SHARDS = 8


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


@register("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.write_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"), N_SHARDS)
    text = F.coalesce(F.col("text"), F.lit(""))
    return shards.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, text, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')) AS size,
         CAST('0x' || substr(md5('29|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, sum(size) AS z, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3.0::DOUBLE * z AS cap FROM s),
l AS (SELECT *, ((SELECT sum(z) FROM w) - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, z, CASE WHEN cap <= level * w THEN cap ELSE (SELECT min_by(level, cap / w) FROM l WHERE cap > level * w) * w END AS target FROM l),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget, CAST(round(target) AS BIGINT) // greatest(z, 1) AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, b.z, b.target, b.epochs, b.budget - b.epochs * b.z AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(z AS BIGINT) AS source_size, round(target, 4) AS target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM p"""


@register("op7_mixing", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, SOURCE_WEIGHTS, max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


@register("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules.judge(docs, keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.OUTPUTS)


OP5_SQL = r"""
WITH iw AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
spots AS (SELECT r, unnest(generate_series(1, len(w))) AS i, w FROM dw),
found AS (
  SELECT r, i, win.n, item FROM spots, (SELECT DISTINCT n FROM win) l, win
  WHERE win.n = l.n AND i + l.n - 1 <= len(w) AND array_to_string(w[i:i + l.n - 1], ' ') = win.s),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS j FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""


@register("op5_decontamination", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.flag(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])


@register("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_dups(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op3_token_output")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs).drop("kept").withColumn("has_repeat", F.col("n_removed") > 0)


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(22 + length(role) + length(text)
         + len(regexp_extract_all(role || ' ' || text, '<\\*(?:/?s>|/?SYS>>|\|[A-Za-z0-9_]+\|>)|\[\\*/?INST\]'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@register("op2_chat_format", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_chats(spark, chat.write_chats(turns, tokenizer_path()), tokenizer_path())


@register("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.train(docs, read_table(spark, sf_dir, "labels"))
    return classifier.score(docs, model, keep=["doc_id"])


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return done.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@register("op12_importance_resampling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@register("op13_minhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_dups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
