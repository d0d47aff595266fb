"""Importance resampling against a row-by-row counterpart."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF

from vesselrisk.llm import importance
from vesselrisk.llm.queries import QUERIES

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = WORD.findall(low)
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def plain(docs, target, n_buckets=10000):
    def counts(texts):
        c = Counter()
        for t in texts:
            c.update(zlib.crc32(f) % n_buckets for f in plain_features(t)[1])
        return c

    s, t = counts(x for _, x in docs), counts(target)
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + n_buckets) / ((s[b] + 1) * (nt + n_buckets)))) for b in range(n_buckets)]
    rows = []
    for d, x in docs:
        words, fs = plain_features(x)
        total = sum(gain[zlib.crc32(f) % n_buckets] for f in fs)
        weight = total // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(words), len(fs), weight, score))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0], -r[3], r[2]))
    rank = {}
    for i, r in enumerate(able[: len(able) * 25 // 100]):
        rank.setdefault(r, []).append(i + 1)
    out = []
    for r in rows:
        own = rank.get(r)
        out.append((r[0], r[2], r[3], r[4], own.pop(0) if own else None))
    return sorted(out, key=str)


def test_query_against_plain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op12_importance_resampling"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target)


def test_odd_rows(spark, odd, none):
    """Nulls, empty, long and repeated texts, long words, no target at all; a column called score is replaced."""
    long_word = [(50, "x" * 3000 + " " + "y" * 700 + " " + "x" * 3000), (51, "Ü" * 400 + " end"), (52, "one")]
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame(long_word, "doc_id long, text string"))
    for texts in (["Plain words", None, ""], []):
        target = spark.createDataFrame([(t,) for t in texts], "text string")
        got = importance.resample(rows, target, min_words=1, share=25)
        docs = [(r.doc_id, r.text) for r in rows.collect()]
        want = plain(docs, texts)
        ours = sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got.collect()), key=str)
        assert ours == sorted((w[:4] for w in want), key=str)
        ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
        assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == got.where("n_words >= 1").count() // 4
    clash = importance.resample(odd, none)
    assert clash.columns.count("score") == 1 and clash.count() == odd.count() and "kept" in clash.columns
    assert importance.resample(none.select("doc_id", "text"), odd).count() == 0


def test_crc_rows_and_features_in_slices():
    rng = np.random.default_rng(5)
    raw = rng.integers(0, 256, 5000, dtype=np.uint8)
    start, size = rng.integers(0, 3000, 400), rng.integers(0, 2000, 400)
    assert importance.crc_rows(raw, start, size).tolist() == [zlib.crc32(raw[a : a + n]) for a, n in zip(start, size)]
    texts = [b"A b-c", b"", b"B c a", b"c"]
    words, doc, bucket = importance.features(texts, 10000)
    assert words.tolist() == [3, 0, 3, 1]
    for i, t in enumerate(texts):
        assert sorted(bucket[doc == i]) == sorted(zlib.crc32(f) % 10000 for f in plain_features(t.decode())[1])


def test_ranks_are_gapless_with_many_equal_scores(spark):
    rows = spark.range(5000).selectExpr("id", "id % 3 AS score")
    got = importance.ranked(rows, [-rows.score], 2500).collect()
    by_rank = sorted((r["rank"], r.score) for r in got if r["rank"])
    assert [k for k, _ in by_rank] == list(range(1, 2501))
    assert [s for _, s in by_rank] == sorted((s for _, s in by_rank), reverse=True)
