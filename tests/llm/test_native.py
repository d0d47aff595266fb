"""Sharding, mixing and quality rules: laws and counts against plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from vesselrisk.llm import mixing, quality_rules, sharding


def test_shards_are_a_shuffle_of_all_rows(spark, odd):
    for n, size in ((3, 1 << 20), (4, 64)):
        rows = sharding.write_shards(odd, n, bucket_bytes=size).collect()
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd.collect())
        per = {}
        for r in rows:
            per.setdefault(r.shard, []).append(r.slot)
        assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in per.values())


def test_shards_of_a_hot_key_are_split(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1500, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("x" * 50).alias("text"))
    got = sharding.write_shards(rows, 4, bucket_bytes=8 << 10)
    assert [r["count"] for r in got.groupBy("shard").count().collect()] == [750] * 4
    hot = [r["count"] for r in got.where("doc_id = 5").groupBy("shard").count().collect()]
    assert min(hot) > 300


def test_shards_stay_whole_when_later_scans_split_files_otherwise(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).select(F.when(F.col("id") % 2 == 0, -5).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows.repartition(24).write.parquet(str(tmp_path / "in"))
    real, sizes = sharding.cut_lineage, iter(["100m", "1k"])
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)

    def resplit(df):
        out = real(df)
        spark.conf.set(setting, next(sizes))
        return out

    monkeypatch.setattr(sharding, "cut_lineage", resplit)
    try:
        got = sharding.write_shards(spark.read.parquet(str(tmp_path / "in")), 4, bucket_bytes=1 << 10).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(int(r.text) for r in got) == list(range(3000))
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(4) for i in range(750)]


def test_no_shards_of_nothing(none):
    assert sharding.write_shards(none, 3).count() == 0


def test_mix_meets_each_target(spark, odd):
    got = mixing.mix(odd, [5.0, 2.0, 1.0]).collect()
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert sorted((r.doc_id or 0, r["size"]) for r in got) == sorted((r.doc_id or 0, words(r.text)) for r in odd.collect())
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == own[0].budget == round(own[0].target)
        assert own[0].source_size == sum(r["size"] for r in own)
        assert own[0].target <= 3 * own[0].source_size + 1e-6
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert got[0].asDict().keys() >= {"words", "kept"}


def test_mix_splits_equal_rows_exactly(spark):
    rows = spark.range(100).select(F.lit(1).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("hot").alias("source"))
    more = spark.createDataFrame([(2, "d " * 450, "small")], "doc_id int, text string, source string")
    got = mixing.mix(rows.unionByName(more), [1.0, 3.0]).collect()
    hot = [r.taken for r in got if r.source == "hot"]
    assert sum(hot) == round(750 / 4)
    assert sum(r.taken for r in got if r.source == "small") == 563  # 562.5 rounded up by Spark


def test_mix_on_other_splits(spark, tmp_path):
    """Files that are cut into other splits when they are read again: the same rows and words are taken."""
    rows = spark.range(600).selectExpr("id % 500 AS doc_id", "repeat('a ', cast(id % 7 AS int) + 1) AS text", "if(id % 5 = 0, 'x', null) AS source")
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    rows.coalesce(1).write.parquet(one)
    rows.repartition(23).write.parquet(many)
    got = [sorted(((r.doc_id, r.source, r.taken) for r in mixing.mix(spark.read.parquet(p), [5.0, 2.0], max_epochs=1).collect()), key=str) for p in (one, many)]
    assert got[0] == got[1]
    for p in (one, many):
        by = mixing.mix(spark.read.parquet(p), [5.0, 2.0]).groupBy("source").agg({"taken": "sum", "budget": "max"}).collect()
        assert all(r["sum(taken)"] == r["max(budget)"] for r in by)


def test_mix_of_nothing(none):
    assert mixing.mix(none, [1.0]).count() == 0


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_quality_counts(spark, odd):
    texts = ["a b c a b c d", "x\ny\nx\n \nx", "one two three one two three one two", "#*|<é> ü"]
    docs = odd.unionByName(spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)], odd.schema[:5]), allowMissingColumns=True)
    for r in quality_rules.judge(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text), r.text and r.text[:50]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_verdict(spark):
    own = [f"{a}{b}" for a in "abcdefghij" for b in ("rel", "tom", "nic", "sud", "pam", "vos")]
    clean = " ".join(f"the {w}en of {w}ary and {w}ist" for w in own)
    shout = " ".join(f"{w.upper()}!***" for w in clean.split())
    docs = spark.createDataFrame([(i, clean[i:], "en") for i in range(30)] + [(99, shout, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert all(got[i].kept for i in range(30)) and not got[99].kept and not got[99].base_failed
    assert got[99].char_distance > quality_rules.MAX_CHAR_DISTANCE


def test_quality_word_limits(spark):
    rng = random.Random(5)
    stems = [a + b + c for a in ("bel", "dor", "min", "tas") for b in ("ar", "en", "il", "os") for c in ("ta", "rok", "nem", "lis")]
    common = {"en": "the of and to in is that for with was".split(), "de": "der die und den von zu das mit sich nicht".split()}

    def prose(lang, n, share=0.3):
        return " ".join(rng.choice(common[lang]) if rng.random() < share else rng.choice(stems) + rng.choice(stems) for _ in range(n))

    rows = [(i, prose(lang, n), lang) for i, (lang, n) in enumerate((x, n) for x in common for n in (60, 120, 400, 1500) for _ in range(30))]
    clean = [(1000 + i, prose("en", 50 + 40 * i), "en") for i in range(10)] + [(1020, prose("de", 300), "de")]
    free = [(2000 + i, prose("en", n, 0.0), "en") for i, n in enumerate((200, 400, 2000))]
    wrong = [(2010, prose("de", 300), "en"), (2011, prose("en", 300), "de")]
    small = [(3000 + i, prose("en", 300), "xx") for i in range(2)]
    docs = spark.createDataFrame([*rows, *clean, *free, *wrong, *small], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert not any(got[i].base_failed or got[i].char_distance > quality_rules.MAX_CHAR_DISTANCE for i in got)
    assert [i for i in got if not got[i].kept] == [i for i in got if 2000 <= i < 3000]


def test_quality_references_shrink_smoothly(spark):
    text = {"aa": "the wordy " * 30, "bb": "und wordy " * 30}
    frame = lambda n: spark.createDataFrame([("aa", text["aa"])] * 100 + [("bb", text["bb"])] * n, "lang string, text string")
    share = {}
    for n in (1, 19, 20, 60):
        refs = {r.r_lang: r for r in quality_rules.references(frame(n)).where("not whole").collect()}
        share[n] = refs["bb"].r_words["und"]
    assert share[1] < share[19] < share[20] < share[60] < 0.5 and share[20] - share[19] < 0.01


def test_quality_of_nothing(none):
    assert quality_rules.judge(none).count() == 0
