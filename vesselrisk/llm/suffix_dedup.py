"""Exact substring dedup: bytes under any string of ``LENGTH`` bytes that occurs elsewhere go.

A sorted array of all suffixes would be many times the corpus, so the array is sparse. Each
window of 400 bytes has an anchor: of the ``GRAM``-byte strings in it, the leftmost with the
least hash. Equal windows have equal anchors at the same place, so a window can only repeat
where its anchor's string repeats. A span is the run of windows with one anchor: about
one per 130 bytes, and a slim row.

1. Spans of anchors that occur once end there. Equal spans (compared by 128 bits of hash)
   have all their windows repeated.
2. Of spans that differ but share the anchor, one of each kind is fetched with its bytes.
   The suffixes that begin at the anchors, and the reversed texts to their left, are put in
   order by deep-shallow sorting with their common prefixes. A window that begins d bytes
   left of the anchor repeats if another one stands in the same run of common prefixes
   of 400 - d bytes to the right and of d bytes to the left.
3. Anchors with more than ``MAX_GROUP`` kinds of spans are not sorted in one task: their
   windows are counted one by one, by 128 bits of hash, with partial sums.

Equal texts are one text for 2, and are judged by 1 (their spans are equal), so hot copies
cost slim rows only. Matches never cross texts.

Defined results: null texts are empty; texts under ``LENGTH`` bytes lose nothing; repeated rows
are texts of their own and remove each other; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import slices
from .common import cut_lineage
from .deepshallow import suffix_order

LENGTH = 400
GRAM = 128
STARTS = LENGTH - GRAM + 1  # strings of GRAM bytes in a window
MAX_GROUP = 4096
HOT_ROWS = 100_000
CHUNK = 2 << 20
BUFFER = 8192
KEY = ["k1", "k2"]
BASE = 0x9E3779B97F4A7C15
TABLE = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


UP, DOWN = _powers(CHUNK + LENGTH)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on: sums of powers, then mixed."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(TABLE[raw] * UP[: len(raw)], dtype=np.uint64)))
    h = (sums[GRAM:] - sums[:-GRAM]) * DOWN[: len(raw) - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks to both sides."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def spans_of(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, last window, hash of the anchor) for texts at [start, stop) of ``raw``.

    ``raw`` has at most CHUNK + LENGTH bytes; positions are those in ``raw``.
    """
    place = np.uint64((1 << 24) - 1)
    h = gram_hashes(raw)
    packed = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_least(packed, STARTS) & place).astype(np.int64)
    text = np.repeat(np.arange(len(start)), np.maximum(stop - start - LENGTH + 1, 0))
    if not len(text):
        none = np.empty(0, np.int64)
        return none, none, none, none, np.empty(0, np.uint64)
    n = np.maximum(stop - start - LENGTH + 1, 0)
    window = np.arange(len(text)) + np.repeat(start - (np.cumsum(n) - n), n)
    a = anchor[window]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (text[1:] != text[:-1])))
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(a)) - 1
    return text[first], a[first], window[first], window[last], h[a[first]]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes]]:
    """(text indices, offsets within the texts, joined bytes), at most CHUNK + LENGTH bytes each; long texts in overlapping pieces."""
    own: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) > CHUNK:
            for at in range(0, len(t) - LENGTH + 1, CHUNK):
                yield [i], [at], t[at : at + CHUNK + LENGTH - 1]
            continue
        if size + len(t) > CHUNK:
            yield own, [0] * len(own), b"".join(texts[j] for j in own)
            own, size = [], 0
        own.append(i)
        size += len(t)
    if own:
        yield own, [0] * len(own), b"".join(texts[j] for j in own)


SPANS = "gram long, span long, k1 long, k2 long, pos long"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, texts in slices(batch, "text", CHUNK):
            k1, k2 = np.asarray(piece.column(1)), np.asarray(piece.column(2))
            for own, offsets, joined in _pieces(texts):
                if len(joined) < LENGTH:
                    continue
                sizes = np.array([len(joined)] if offsets[0] or len(texts[own[0]]) > CHUNK else [len(texts[i]) for i in own], np.int64)
                stop = np.cumsum(sizes)
                text, a, lo, hi, h = spans_of(np.frombuffer(joined, np.uint8), stop - sizes, stop)
                digest = xxhash.xxh3_64_intdigest
                left = a - lo
                span = np.array(
                    [digest(joined[i : j + LENGTH], d) for i, j, d in zip(lo.tolist(), hi.tolist(), left.tolist())], np.uint64
                )
                at = (a - (stop - sizes)[text] + np.array(offsets, np.int64)[text]) << 20 | left << 10 | (hi - lo)
                who = np.array(own, np.int64)[text]
                cols = [h.view(np.int64), span.view(np.int64), k1[who], k2[who], at]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["gram", "span", "k1", "k2", "pos"])


def _place(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) in the text."""
    a, left, more = pos >> 20, (pos >> 10) & 1023, pos & 1023
    return a, a - left, a - left + more


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, k1, k2, wanted: (gram, size, pos) array) to a row per span with its bytes."""
    for batch in batches:
        for piece, texts in slices(batch, "text", 1 << 20):
            k1, k2, wanted = (piece.column(i) for i in (1, 2, 3))
            n = np.diff(np.asarray(wanted.offsets))
            flat = wanted.flatten()
            gram, size, pos = (np.asarray(flat.field(i)) for i in range(3))
            who = np.repeat(np.arange(len(texts)), n)
            _, lo, hi = _place(pos)
            found = [texts[t][i : j + LENGTH] for t, i, j in zip(who.tolist(), lo.tolist(), hi.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(size), pa.array(np.asarray(k1)[who]), pa.array(np.asarray(k2)[who]), pa.array(pos), pa.array(found, pa.binary())],
                names=["gram", "size", "k1", "k2", "pos", "bytes"],
            )


def repeated_windows(gram: np.ndarray, pos: np.ndarray, found: list[bytes]) -> np.ndarray:
    """(distance, span) matrix: does the window that begins so many bytes left of the anchor repeat among these spans?"""
    _, group = np.unique(gram, return_inverse=True)
    a, lo, hi = _place(pos)
    left, n = a - lo, len(found)
    right = [s[k:] for s, k in zip(found, left.tolist())]
    back = [s[:k][::-1] for s, k in zip(found, left.tolist())]
    r_order, r_lcp = suffix_order(right, group, GRAM)
    l_order, l_lcp = suffix_order(back, group, 0)
    out = np.zeros((STARTS, n), bool)
    r_run, l_run = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(left.max()) + 1):
        valid = np.nonzero((d <= left) & (d >= a - hi))[0]
        if len(valid) < 2:
            continue
        new = r_lcp < LENGTH - d
        r_run[r_order] = np.cumsum(new)
        same = l_lcp >= d  # for d = 0 all spans of a group are in one run
        g = group[l_order]
        same[1:] &= g[1:] == g[:-1]
        same[0] = False
        l_run[l_order] = np.cumsum(~same)
        key = r_run[valid] * (n + 1) + l_run[valid]
        order = np.argsort(key, kind="stable")
        k = key[order]
        equal = k[1:] == k[:-1]
        twice = np.zeros(len(k), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        out[d, valid[order[twice]]] = True
    return out


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans in order of their anchors to repeated ranges of windows; whole anchors, a buffer at a time."""
    held: list[pa.RecordBatch] = []

    def out(t: pa.Table) -> pa.RecordBatch:
        gram, k1, k2, pos = (t.column(c).to_numpy() for c in ("gram", "k1", "k2", "pos"))
        hit = repeated_windows(gram, pos, t.column("bytes").to_pylist())
        a, _, _ = _place(pos)
        change = np.diff(np.pad(hit.astype(np.int8), ((1, 1), (0, 0))), axis=0)
        span_a, first = np.nonzero((change == 1).T)  # by span, then distance
        span_b, end = np.nonzero((change == -1).T)
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[span_a]), pa.array(k2[span_a]), pa.array(a[span_a] - end + 1), pa.array(a[span_a] - first)], names=["k1", "k2", "lo", "hi"]
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BUFFER:
            t = pa.Table.from_batches(held).combine_chunks()
            gram = t.column("gram").to_numpy()
            cut = int(np.nonzero(gram != gram[-1])[0][-1]) + 1 if gram[0] != gram[-1] else 0
            if cut:
                yield out(t.slice(0, cut))
            held = t.slice(cut).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield out(pa.Table.from_batches(held).combine_chunks())


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans to single windows with two hashes."""
    for batch in batches:
        pos = np.asarray(batch.column(4))
        _, lo, hi = _place(pos)
        n = hi - lo + 1
        who = np.repeat(np.arange(len(pos)), n)
        off = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        found = batch.column(5).to_pylist()
        cut = [found[w][o : o + LENGTH] for w, o in zip(who.tolist(), off.tolist())]
        h = [[f(c) for c in cut] for f in (xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest)]
        cols = [np.array(x, np.uint64).view(np.int64) for x in h] + [np.asarray(batch.column(2))[who], np.asarray(batch.column(3))[who], lo[who] + off]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["h1", "h2", "k1", "k2", "lo"])


def _occurring(spans: DataFrame) -> DataFrame:
    """Spans whose anchor occurs with another span or place: adds ``n`` (places of the equal span), ``kinds`` (spans of the anchor), ``rank`` (1: the one to fetch)."""
    span, anchor = Window.partitionBy("gram", "span"), Window.partitionBy("gram")
    ranked = spans.withColumn("n", F.count("*").over(span)).withColumn("rank", F.row_number().over(span.orderBy(*KEY, "pos")))
    return ranked.withColumn("kinds", F.sum((F.col("rank") == 1).cast("long")).over(anchor)).where("n > 1 or kinds > 1")


def _occurring_hot(spans: DataFrame) -> DataFrame:
    """The same for anchors of very many rows, by partial sums and joins that Spark may split."""
    kinds = spans.groupBy("gram", "span").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "pos")).alias("one"))
    per = kinds.groupBy("gram").agg(F.count("*").alias("kinds"))
    joined = spans.join(kinds, ["gram", "span"]).join(per, "gram")
    rank = F.when(F.struct(*KEY, "pos") == F.col("one"), 1).otherwise(2)
    return joined.select("gram", "span", *KEY, "pos", "n", rank.alias("rank"), "kinds").where("n > 1 or kinds > 1")


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` with text, k1, k2: (distinct texts by k1, k2; ranges of repeated window starts (k1, k2, lo, hi))."""
    spans = docs.select("text", *KEY).mapInArrow(_spans, SPANS)
    hot = cut_lineage(spans.groupBy("gram").count().where(F.col("count") > HOT_ROWS).select("gram"))
    if hot.isEmpty():
        found = _occurring(spans)
    else:  # fewer hot anchors than rows / HOT_ROWS
        found = _occurring(spans.join(F.broadcast(hot), "gram", "left_anti")).unionByName(
            _occurring_hot(spans.join(F.broadcast(hot), "gram")).select("gram", "span", *KEY, "pos", "n", "rank", "kinds")
        )
    found = cut_lineage(found)
    first = F.col("pos").bitwiseAND(F.lit(1023 << 10))
    lo = F.shiftright("pos", 20) - F.shiftright(first, 10)
    whole = found.where("n > 1").select(*KEY, lo.alias("lo"), (lo + F.col("pos").bitwiseAND(F.lit(1023))).alias("hi"))
    texts = docs.groupBy(*KEY).agg(F.max("text").alias("text"))
    wanted = found.where("rank = 1 and kinds > 1").groupBy(*KEY).agg(F.collect_list(F.struct("gram", "kinds", "pos")).alias("wanted"))  # bounded by the text
    fetched = texts.join(wanted, KEY).select("text", *KEY, "wanted").mapInArrow(_fetch, "gram long, size long, k1 long, k2 long, pos long, bytes binary")
    fetched = cut_lineage(fetched)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = fetched.where(F.col("size") <= MAX_GROUP).repartition(n, "gram").sortWithinPartitions("gram")
    ranges = whole.unionByName(small.mapInArrow(_sorted_groups, "k1 long, k2 long, lo long, hi long"))
    large = fetched.where(F.col("size") > MAX_GROUP)
    if not large.isEmpty():
        windows = large.mapInArrow(_windows, "h1 long, h2 long, k1 long, k2 long, lo long")
        often = windows.groupBy("h1", "h2").count().where("count > 1").drop("count")
        ranges = ranges.unionByName(windows.join(often, ["h1", "h2"]).select(*KEY, "lo", F.col("lo").alias("hi")))
    return texts, ranges


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, texts in slices(batch, "text", CHUNK):
            kept, spans = [], []
            for t, cuts in zip(texts, piece.column(3).to_pylist()):
                runs: list[list[int]] = []
                for c in sorted((c["lo"], c["hi"] + LENGTH) for c in cuts or []):
                    if runs and c[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], c[1])
                    else:
                        runs.append(list(c))
                at = [0, *(x for r in runs for x in r), len(t)]
                kept.append(b"".join(t[i:j] for i, j in zip(at[::2], at[1::2])))
                spans.append(len(runs))
            cols = [piece.column(1), piece.column(2), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64())]
            cols += [pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): a row for each document; ``kept`` are the bytes that stay."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.col(f"`{doc_id}`").alias(doc_id), t.alias("text"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2"))
    texts, ranges = repeated_ranges(keyed.select("text", *KEY))
    per_text = ranges.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("cuts"))  # bounded by the text
    result = texts.join(per_text, KEY, "left").select("text", *KEY, "cuts").mapInArrow(
        _remove, "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return keyed.select(doc_id, *KEY).join(result, KEY).drop(*KEY)
