"""Target-distribution importance resampling over hashed word runs.

A document's features are its runs of one and two words. Each goes to the bucket crc32 modulo
``N_BUCKETS``. The log ratio of a bucket's smoothed share in the target texts to that in the
corpus is its gain; a document's weight is the mean gain of its features, and documents are
drawn without replacement by weight plus Gumbel noise that depends on seed and id only.

The checksums are worked out in length-bucketed matrices: in a slice of texts, words get
numbers and word pairs become pairs of numbers, so each distinct feature is met once. Distinct
features of equal length are the rows of a two-dimensional uint8 array; all their CRCs go
forward together, one column at a time, and are scattered back to the places of the
features. Features over ``LONG`` bytes, too few to share columns, have theirs from zlib.

Both passes over the texts leave slim rows: partial bucket counts for each task (``N_BUCKETS`` sums
reach the driver, whatever the table's size), then a number triple a document. Ranks come from a
range sort of the slim rows, with numbers within a range and the ranges' totals before it.

Defined results: null and empty texts have no features, weight 0 and are not eligible. A null id
counts as an empty one in the noise and comes last among ties. Rows of equal score and id are
ranked in the order of their weights and feature counts, then in any order. An empty table gives an empty
one; input columns called like a result column are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns
from .common import cut_lineage

N_BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 25  # percent of the eligible documents
SEED = 7
LONG = 512
SLICE = 2 << 20
OUTPUTS = ["n_words", "n_features", "weight", "score", "rank"]
IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _crc_table() -> np.ndarray:
    """The byte table of the reflected polynomial 0xEDB88320."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


CRC = _crc_table()


def crc_rows(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of ``raw[start : start + size]`` for each row, in matrices of equal length."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(size, kind="stable")
    sizes, first = np.unique(size[order], return_index=True)
    for n, group in zip(sizes.tolist(), np.split(order, first[1:])):
        if n > LONG:
            out[group] = [zlib.crc32(raw[a : a + n]) for a in start[group].tolist()]
            continue
        rows = raw[start[group][:, None] + np.arange(n)]
        crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
        for column in rows.T:
            crc = CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[group] = ~crc
    return out


def number_words(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, place of one of its occurrences by number); equal bytes have equal numbers."""
    number, example = np.empty(len(start), np.int64), []
    order = np.argsort(size, kind="stable")
    sizes, first = np.unique(size[order], return_index=True)
    used = 0
    for n, group in zip(sizes.tolist(), np.split(order, first[1:])) if len(start) else ():
        if n <= 8:  # the bytes as one integer
            key = np.zeros(len(group), np.uint64)
            for i in range(n):
                key = (key << np.uint64(8)) | raw[start[group] + i]
        elif n <= LONG:
            key = np.ascontiguousarray(raw[start[group][:, None] + np.arange(n)]).view(f"V{n}").ravel()
        else:
            own: dict[bytes, int] = {}
            key = np.array([own.setdefault(raw[a : a + n].tobytes(), len(own)) for a in start[group].tolist()])
        _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        number[group] = inverse + used
        example.append(group[at])
        used += len(at)
    return number, np.concatenate(example) if example else np.empty(0, np.int64)


def features(texts: list[bytes], n_buckets: int = N_BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = LOWER[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    ends_of = np.cumsum(sizes + 1)
    inside = np.concatenate(([False], IS_WORD[raw], [False]))
    edge = np.nonzero(inside[1:] != inside[:-1])[0]
    start, stop = edge[::2], edge[1::2]
    doc = np.searchsorted(ends_of, start, side="right")
    size = stop - start
    number, example = number_words(raw, start, size)
    # The words once more, each with one blank before the next, so that a word pair is one run of bytes.
    pairs_at = np.nonzero(doc[1:] == doc[:-1])[0]
    pair = number[pairs_at] * max(len(example), 1) + number[pairs_at + 1]
    distinct, at, inverse = np.unique(pair, return_index=True, return_inverse=True)
    left = pairs_at[at]
    n_left, n_right = size[left], size[left + 1]
    word_crc = crc_rows(raw, start[example], size[example])
    joined, where = _join_pairs(raw, start[left], n_left, start[left + 1], n_right)
    pair_crc = crc_rows(joined, where, n_left + 1 + n_right)
    bucket = np.concatenate([word_crc[number], pair_crc[inverse]]) % np.uint32(n_buckets)
    return np.bincount(doc, minlength=len(texts)), np.concatenate([doc, doc[pairs_at]]), bucket.astype(np.int64)


def _join_pairs(raw: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes ``raw[a:a+n] + b" " + raw[b:b+m]`` of all rows one after another, and their starts."""
    total = n + 1 + m
    where = np.cumsum(total) - total
    row = np.repeat(np.arange(len(a)), total)
    off = np.arange(int(total.sum())) - where[row]
    from_a = off < n[row]
    source = np.where(from_a, a[row] + off, b[row] + off - n[row] - 1)
    blank = off == n[row]
    return np.where(blank, np.uint8(32), raw[np.where(blank, 0, source)]), where


def bucket_counts(texts: DataFrame, text: str = "text", n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for _, own in slices(batch, text, SLICE):
                total += np.bincount(features(own, n_buckets)[2], minlength=n_buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "c"])

    parts = texts.select(F.col(f"`{text}`").alias(text)).mapInArrow(run, "bucket int, c long")
    out = np.zeros(n_buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("c").alias("c")).collect():  # at most n_buckets rows
        out[r.bucket] = r.c
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) for each bucket, in doubles."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = lambda a, b: (b + 1.0) * (s + n) / ((a + 1.0) * (t + n))
    return np.array([math.floor(1000 * math.log(ratio(float(a), float(b)))) for a, b in zip(corpus, target)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns, ``n_words``, ``n_features`` and ``weight`` (floored mean gain of the features, 0 without any)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in OUTPUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, own in slices(batch, text, SLICE):
                words, doc, bucket = features(own, len(gain))
                n = np.bincount(doc, minlength=len(own))
                total = np.bincount(doc, weights=gain[bucket], minlength=len(own)).astype(np.int64)  # whole numbers under 2**53
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield with_columns(piece, keep, {"n_words": pa.array(words, pa.int64()), "n_features": pa.array(n, pa.int64()), "weight": pa.array(weight, pa.int64())})

    names = ("n_words", "n_features", "weight")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in names])
    return docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]).mapInArrow(run, schema)


def with_score(rows: DataFrame, doc_id: str, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise from a hash of seed and id, in thousandths."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, order: list, n_first) -> DataFrame:
    """Adds ``rank`` (1, 2, 3 .. in the given order) to the first ``n_first`` rows; the others' stays null.

    A range sort deals the rows out; their numbers within a range are fixed by a checkpoint before the ranges' totals
    (a row for each range) are added.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[o.alias(f"o{i}") for i, o in enumerate(order)])
    # A random last key only splits rows that are equal in all others.
    keys = [f"o{i}" for i in range(len(order))]
    dealt = keyed.withColumn("tie", F.xxhash64("row", F.monotonically_increasing_id())).repartitionByRange(n, *keys, "tie").sortWithinPartitions(*keys, "tie")
    # Numbers in physical order: the partition in the upper bits, the place in it in the lower 33.
    placed = cut_lineage(dealt.select("row", F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    totals = placed.groupBy(part.alias("part")).count()
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # one row a partition
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before") + 1
    out = placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("place", place)
    return out.select("row.*", F.when(F.col("place") <= n_first, F.col("place")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
    n_buckets: int = N_BUCKETS, min_words: int = MIN_WORDS, share: int = SHARE, seed: int = SEED,
) -> DataFrame:
    """Every row's ``keep`` columns (all by default) and ``OUTPUTS``; ``rank`` is null for those that are not drawn.

    ``target`` has a column called as ``text`` with the texts whose distribution the draw follows.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in OUTPUTS]
    gain = gains(bucket_counts(docs, text, n_buckets), bucket_counts(target, text, n_buckets))
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    weighed = cut_lineage(with_score(weigh(slim, gain, "text", ["row", "doc_id"]), "doc_id", seed))
    eligible = F.col("n_words") >= min_words
    n_first = weighed.where(eligible).count() * share // 100
    order = [-F.col("score"), F.col("doc_id").isNull(), F.col("doc_id"), -F.col("weight"), F.col("n_features")]
    drawn = ranked(weighed.where(eligible), order, n_first)
    rest = weighed.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    both = drawn.unionByName(rest)
    return both.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *OUTPUTS)

