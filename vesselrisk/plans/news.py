"""News context per vessel as a batch full-text search (BM25 as joins and aggregations).

Query text per vessel = flag + the first two upper-cased name tokens longer
than two characters, tokenised like the documents. The best ``3n`` documents
by BM25 are kept, then the newest ``n`` of those.

Exact top-k without pairing vessels with the postings of terms that many of them ask
for: terms of one vessel only are its own, the others are shared. A document that matches
none of a vessel's own terms scores through the shared ones alone, so its rank among
such documents is the same for every vessel with the same set of shared terms. Hence the
exact top ``3n`` lies in (top ``3n`` of the shared set, computed once per distinct set) ∪
(documents with an own term; each posting of an own term belongs to one vessel).
Candidates are then rescored with the full query. Ties break on the larger doc id in both stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import tokens
from ..operators.ordered import top_k_per_group
from ..operators.tracks import reuse
from ..session import cut_lineage

FEW_TERMS = 50_000  # terms up to which a table of them is broadcast


def doc_term_scores(docs: DataFrame, asked: DataFrame, k1: float = C.BM25_K1, b: float = C.BM25_B) -> DataFrame:
    """(term, doc_id, s): BM25 contribution of each asked ``term`` in each document (whole texts)."""
    toks = docs.select("doc_id", tokens(F.col("text")).alias("t"))
    dl = toks.select("doc_id", F.size("t").alias("dl"))
    # The asked terms that any document has, from the documents' distinct words: with few of them no word of a text is sent.
    words = toks.select(F.explode("t").alias("term")).distinct()
    known = cut_lineage(words.join(asked.select("term").distinct(), "term", "left_semi"))
    if known.count() <= FEW_TERMS:
        known = F.broadcast(known)
    tf = toks.select("doc_id", F.explode("t").alias("term")).join(known, "term", "left_semi").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    stats = dl.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
    n, avgdl = int(stats["n"]), float(stats["avgdl"] or 0.0)
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1.0 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.lit(k1) * (1.0 - b + b * F.col("dl") / F.lit(avgdl if avgdl > 0 else 1.0))
    return tf.join(dl, "doc_id").join(df, "term").select(
        "term", "doc_id", (idf * F.col("tf") * (k1 + 1) / (F.col("tf") + norm)).alias("s"))


def query_terms(vessels: DataFrame, name_tokens: int = C.NEWS_NAME_TOKENS,
                min_len: int = C.NEWS_MIN_TOKEN_LEN) -> DataFrame:
    """(mmsi, term) of each vessel's query text."""
    words = F.filter(F.split(F.upper(F.coalesce(F.col("name"), F.lit(""))), r"\s+"), lambda w: F.length(w) >= min_len)
    text = F.concat_ws(" ", F.coalesce(F.col("flag"), F.lit("")), F.array_join(F.slice(words, 1, name_tokens), " "))
    return vessels.select("mmsi", F.explode(F.array_distinct(tokens(text))).alias("term"))


def news_context(vessels: DataFrame, docs: DataFrame, n: int = C.NEWS_RESULTS, shared_from: int = 2) -> DataFrame:
    """Top ``n`` newest of the best ``3n`` documents per vessel: (mmsi, rank, doc_id, score).

    Any split of the terms gives the same result; ``shared_from`` is the number of vessels from which a term is shared.
    """
    k = n * C.NEWS_CANDIDATE_FACTOR
    q = query_terms(vessels)
    uses = q.groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    s = reuse(doc_term_scores(docs, uses))
    # A term without a posting scores nowhere; with it, each vessel's set of shared terms would be one of its own.
    q = q.join(s.select("term").distinct(), "term", "left_semi")
    qs = q.join(uses, "term")
    own = qs.where(F.col("uses") < shared_from).select("mmsi", "term")
    shared = qs.where(F.col("uses") >= shared_from).select("mmsi", "term")
    cand = own.join(s.select("term", "doc_id"), "term").select("mmsi", "doc_id")
    # Shared terms: best k documents once per distinct set.
    sig = shared.groupBy("mmsi").agg(F.array_sort(F.collect_set("term")).alias("sig"))
    sigs = sig.select("sig").distinct()
    sig_scores = (
        sigs.select("sig", F.explode("sig").alias("term")).join(s, "term")
        .groupBy("sig", "doc_id").agg(F.sum("s").alias("cs"))
    )
    sig_top = top_k_per_group(sig_scores, ["sig"], [F.col("cs").desc(), F.col("doc_id").desc()], k)
    cand = cand.unionByName(sig.join(sig_top, "sig").select("mmsi", "doc_id")).distinct()
    # Rescore candidates with the whole query (at most 5 terms per vessel).
    full = (
        cand.join(q, "mmsi").join(s, ["term", "doc_id"])
        .groupBy("mmsi", "doc_id").agg(F.sum("s").alias("score"))
    )
    best = top_k_per_group(full, ["mmsi"], [F.col("score").desc(), F.col("doc_id").desc()], k, "srank")
    newest = top_k_per_group(best, ["mmsi"], [F.col("doc_id").desc()], n, "rank")
    return newest.select("mmsi", F.col("rank").cast("long"), "doc_id", "score")
