"""SimHash near-dedup with pivot distance tables.

A fingerprint has 64 bits: bit b is set if over half of the document's three-word shingles
have it set in their XXH64. Equal fingerprints become one row first, so copies cost nothing
further. Fingerprints that differ in at most three bits are then linked:

1. The 64 bits are cut into five blocks. Three differing bits leave at least two blocks
   untouched, so every linked pair meets in one of the ten tables keyed by two whole blocks.
   A key with more rows than ``HOT`` is keyed anew by quarters of the other bits, one of which
   a linked pair also shares.
2. In a task, the Hamming distances of the fingerprints to ``N_PIVOTS`` reference fingerprints
   are worked out once. By the triangle inequality the coordinates of a linked pair differ by
   three at most: rows are sorted by the first coordinate within their key, so only rows near
   each other are looked at, and a pair goes on only while its maximum coordinate
   difference stays within three.
3. The survivors' own distance decides. Links are folded into one edge per fingerprint and
   task, as only the components are asked for; nothing emits all pairs of a group.

Defined results: null and empty texts have the fingerprint zero; null ids may be in a group
but are its least id only if all are null; repeated rows are members of one group;
an empty table gives an empty one; input columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns
from .common import cut_lineage, shared_path
from .components import components

MAX_BITS = 3
SHINGLE = 3
SEED = 42
N_PIVOTS = 32
HOT = 4096
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # (first bit, bits)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.translate(LOWER).split()  # splits at space and the bytes 9 to 13
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the 64 bits as a long)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, text):
                own: dict[bytes, int] = {}
                for t in texts:
                    if t not in own:
                        own[t] = fingerprint(t, shingle)
                fps = np.array([own[t] for t in texts], np.uint64).view(np.int64)
                yield with_columns(piece, keep, {"fp": pa.array(fps, pa.int64())})

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])
    return docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]).mapInArrow(run, schema)


class Roots:
    """Union-find over 0..n-1 for arrays of pairs; the root is the least member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.of[a], self.of[b]
            on = ra != rb
            a, b, ra, rb = a[on], b[on], ra[on], rb[on]
            np.minimum.at(self.of, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.of[self.of]
                if np.array_equal(up, self.of):
                    break
                self.of = up


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints; fixed by their number."""
    return np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64)


def linked(keys: np.ndarray, fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) of the fingerprints that are linked to a lesser one under the same key, directly or not."""
    references = pivots()
    first = np.bitwise_count(fps ^ references[0]).astype(np.int16)
    order = np.lexsort((fps, first, keys))
    keys, fps, first = keys[order], fps[order], first[order]
    table = np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)
    roots = Roots(len(fps))
    a = np.arange(len(fps) - 1)
    step = 1
    while len(a):
        a = a[a + step < len(fps)]
        b = a + step
        near = (keys[a] == keys[b]) & (first[b] - first[a] <= max_bits)  # sorted: no later row comes nearer
        a, b = a[near], b[near]
        left, right = a, b
        for p in range(1, references.size, 4):  # the maximum over four coordinates at a time
            on = (np.abs(table[left, p : p + 4] - table[right, p : p + 4]) <= max_bits).all(axis=1)
            left, right = left[on], right[on]
        on = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
        roots.join(left[on], right[on])
        step += 1
    # The root as the least fingerprint (signed) of the group, so that edges point one way.
    signed = fps.view(np.int64)
    least = np.full(len(fps), np.iinfo(np.int64).max)
    np.minimum.at(least, roots.of, signed)
    root = least[roots.of]
    return signed[root != signed], root[root != signed]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a key's rows are held together, keys one batch after another."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)

    def out(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        twice = np.zeros(len(k), bool)
        same = k[1:] == k[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        node, root = linked(k[twice], f[twice].view(np.uint64)) if twice.any() else (f[:0], f[:0])
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["u", "v"])

    for batch in batches:
        keys = np.concatenate([keys, np.asarray(batch.column(0))])
        fps = np.concatenate([fps, np.asarray(batch.column(1))])
        if len(keys) >= 1 << 17:
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if cut:
                yield out(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield out(keys, fps)


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, whose components are those of all pairs within ``MAX_BITS``; ``fps`` has distinct ``fp``."""

    def bits(first: int, n: int):
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << n) - 1))

    two = F.array(
        *[F.xxhash64(F.lit(i), bits(*BLOCKS[a]), bits(*BLOCKS[b])) for i, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))]
    )
    rows = fps.select("fp", F.posexplode(two).alias("table", "key"))
    hot = cut_lineage(rows.groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot")))
    # The other three blocks of a table in quarters: 64 bits without the two of the key, cut in four.
    rest = [[x for i, (f, n) in enumerate(BLOCKS) if i not in pair for x in range(f, f + n)] for pair in combinations(range(len(BLOCKS)), 2)]
    masks = F.array(*[F.array(*[F.lit(_mask(r[len(r) * q // 4 : len(r) * (q + 1) // 4])) for q in range(4)]) for r in rest])
    quarters = F.transform(F.element_at(masks, F.col("table") + 1), lambda m, q: F.xxhash64("key", q, F.col("fp").bitwiseAND(m)))
    few = hot.count() <= 100_000
    keyed = rows.join(F.broadcast(hot) if few else hot, "key", "left")
    dealt = keyed.select("fp", F.explode(F.when(F.col("hot"), quarters).otherwise(F.array("key"))).alias("key"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.select("key", "fp").repartition(n, "key").sortWithinPartitions("key").mapInArrow(_edges, "u long, v long")


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def groups(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(fp, root, component_id) for ``prints`` with ``doc_id`` and ``fp``: the least id that is reachable by links."""
    each = cut_lineage(prints.groupBy("fp").agg(F.min(doc_id).alias("least")))
    root = components(links(each.select("fp")))
    rooted = each.join(root, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")


def near_dups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), a row for each document."""
    prints = cut_lineage(with_fingerprint(docs, text, [doc_id]))
    return prints.join(groups(prints, doc_id), "fp").select(doc_id, "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the least id, of rows with that id the first in the input.

    The numbered rows are written once and both uses read them there: a second scan of the input may number them otherwise.
    """
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "numbered")
    docs.withColumn("vr_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    prints = cut_lineage(with_fingerprint(placed, text, [doc_id, "vr_at"]))
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col("vr_at"))
    kept = prints.join(groups(prints, doc_id).select("fp", "root"), "fp").groupBy("root").agg(F.min(order)["vr_at"].alias("vr_at"))
    return placed.join(kept, "vr_at", "left_semi").drop("vr_at")
