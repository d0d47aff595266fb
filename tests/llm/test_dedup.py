"""SimHash groups, exact substring dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from vesselrisk.llm import components as components_module
from vesselrisk.llm import decontamination, simhash, suffix_dedup
from vesselrisk.llm.deepshallow import lcp, suffix_order


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(ids, fps):
    group = list(range(len(ids)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        least.setdefault(top(i), []).append(d)
    return [min((d for d in least[top(i)] if d is not None), default=None) for i in range(len(ids))]


def test_simhash_groups(spark, odd):
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    near = []
    for i in range(40):
        w = list(words)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
        near.append((1000 + i, " ".join(w)))
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_dups(rows).collect()), key=str)
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    fps = [plain_fingerprint(t) for _, t in texts]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = sorted(zip([d for d, _ in texts], signed, plain_groups([d for d, _ in texts], fps)), key=str)
    assert got == want
    kept = simhash.keep_one(rows).collect()
    assert len(kept) == len({c for *_, c in want})


def test_links_find_all_pairs_of_a_dense_group(monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 64, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), False)) for _ in range(60)], np.uint64) for c in centre]))
    node, root = simhash.linked(np.zeros(len(fps), np.int64), fps)
    want = plain_groups(fps.view(np.int64).tolist(), fps.tolist())
    got = dict(zip(node.tolist(), root.tolist()))
    assert [got.get(f, f) for f in fps.view(np.int64).tolist()] == want


def test_hot_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 10)
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(26, 64), rng.randrange(6))) for _ in range(200)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(rows).collect()}
    assert [got[f] for f in signed] == plain_groups(list(range(len(fps))), fps)


def test_simhash_of_nothing(none):
    assert simhash.near_dups(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(60):
        pre = rng.choice([0, 3])
        group = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        letters = rng.choice([b"ab", b"\x00a", b"a"])
        strings = [bytes([65 + g]) * pre + bytes(rng.choice(letters) for _ in range(rng.randrange(50))) for g in group]
        order, common = suffix_order(strings, np.array(group), pre)
        assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
        for k in range(1, len(order)):
            i, j = order[k - 1], order[k]
            assert common[k] == (lcp(strings[i], strings[j]) if group[i] == group[j] else 0)


def plain_removed(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("group", [4096, 1])
def test_substring_dedup(spark, odd, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", group)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 100_000 if group > 1 else 3)
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, long = text(700), text(3000)
    docs = [(i, text(rng.randrange(500)) + shared[rng.randrange(250) : 700 - rng.randrange(120)] + text(rng.randrange(500))) for i in range(20)]
    docs += [(50, long), (51, long[:1500] + "#" + long[1501:]), (52, long[:399]), (53, "ab" * 900), (54, text(100) + long[1200:1800])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd.where("doc_id is null or doc_id <> 7").select("doc_id", "text"))
    want = plain_removed([(r.text or "").encode() for r in rows.collect()], 400)
    want = sorted((str(r.doc_id), *w) for r, w in zip(rows.collect(), want))
    got = suffix_dedup.dedup(rows).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_long_texts_are_cut_into_overlapping_pieces(monkeypatch):
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcd") for _ in range(9000))
    whole = list(suffix_dedup._pieces([text]))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2000)
    cut = list(suffix_dedup._pieces([b"x" * 10, text, b"y" * 5]))
    windows = sorted(at + i for own, (at, *_), t in cut if own == [1] for i in range(len(t) - 399))
    assert windows == list(range(len(text) - 399)) and len(whole) == 1


def test_substring_dedup_of_nothing(none):
    assert suffix_dedup.dedup(none).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_hits(text, items):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words, hit, found = WORD.findall(low(text)), set(), set()
    for item, t in items:
        w = WORD.findall(low(t))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_decontamination(spark, odd, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "a", "é1", "rivers", "of", "Über", "x"]) + rng.choice(["", "", "s", "er"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([25, 12, 10, 9, 3, 1, 0, 2])] + [(8, None), (9, "The!! River"), (2, "zz top")]
    texts = [" ".join(word() for _ in range(60)) for _ in range(15)] + [f"pre {t or ''}, post" for _, t in items] + ["THE  RIVER", "the-river's zz\ttop"]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(odd.select("doc_id", "text").where("doc_id is null or doc_id <> 7"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.flag(docs, bench).collect()))
    assert got == sorted(plain_hits(r.text, items) for r in docs.collect())


def test_decontamination_of_and_by_nothing(spark, odd, none):
    bench = spark.createDataFrame([(1, "the river")], "item_id long, text string")
    assert decontamination.flag(none, bench).count() == 0
    assert {r.contaminated for r in decontamination.flag(odd, bench.where("false")).collect()} == {False}


def test_keep_one_when_later_scans_split_files_otherwise(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=80)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string")
    docs.repartition(24).write.parquet(str(tmp_path / "in"))
    real, setting = simhash.groups, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)

    def resplit(*a):
        out = real(*a)
        spark.conf.set(setting, "1k")
        return out

    spark.conf.set(setting, "100m")
    monkeypatch.setattr(simhash, "groups", resplit)
    try:
        got = sorted(r.doc_id for r in simhash.keep_one(spark.read.parquet(str(tmp_path / "in"))).collect())
    finally:
        spark.conf.set(setting, before)
    groups = plain_groups(list(range(200)), [plain_fingerprint(t) for t in texts])
    assert got == sorted(set(groups))


@pytest.mark.parametrize("buffer", [1 << 17, 7])
def test_components_contract_edges_within_tasks(spark, monkeypatch, buffer):
    """A long path and some stars, in one last task and with stars over what many buffers leave."""
    stars = []
    monkeypatch.setattr(components_module, "BUFFER", buffer)
    monkeypatch.setattr(components_module, "_large_star", lambda *a, f=components_module._large_star: stars.append(1) or f(*a))
    edges = [(i + 1, i) for i in range(100, 160)] + [(i, 5) for i in range(10, 40)] + [(200, 30), (200, 30)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {(r["node"], r["root"]) for r in components_module.components(frame, 20).collect()}
    assert got == {(i, 100) for i in range(101, 161)} | {(i, 5) for i in [*range(10, 40), 200]}
    assert bool(stars) == (buffer == 7)
    assert components_module.components(frame.where("false"), 20).count() == 0
