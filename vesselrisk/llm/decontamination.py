"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are all windows of ten words of the benchmark items (an item of fewer words is one
window), as bytes with one space around each word. The patterns of a block are put into
classes by length. A class has a shift table over hashed byte blocks: how far the search may
move on when a block ends at the position looked at. Shift 0 leads to the bucket of patterns
with that block at the end of their first ``m`` bytes and the same first bytes, and a direct
comparison of all bytes confirms the occurrence. The search runs through many places of a
text buffer side by side.

Benchmark items are taken in blocks of at most ``BLOCK_BYTES``; the driver holds one block at a
time, executors one block's tables, and each block meets all documents. Documents are never
shuffled.

Defined results: null and empty texts have no words and no hits; items without words never
occur; repeated items count once by id; a null item id counts as an empty id; an empty
benchmark hits nothing; input columns called like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns
from .common import cut_lineage

WINDOW = 10
BLOCK_BYTES = 8 << 20
LANE = 2048
OUTPUTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
# Bytes of words after lower-casing A-Z: digits, a-z and all of non-ASCII characters; 32 for others.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


class Buffer:
    """Texts side by side, each as `` word word .. word `` and a zero byte."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\x00".join([*texts, b""]) + b"\x00" * 8, np.uint8)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.cumsum(lengths) - 1
        folded = FOLD[raw[: ends[-1] + 1]]
        folded[ends] = 0
        word = folded > 32
        first = word.copy()
        first[1:] &= ~word[:-1]
        grows = word.astype(np.int64) + first
        grows[ends] += 2
        at = np.cumsum(grows) - 1
        self.n = int(at[-1]) + 1
        self.bytes = np.full(self.n + 8, 32, np.uint8)
        self.bytes[at[word]] = folded[word]
        self.bytes[at[ends]] = 0
        self.words = at[first]  # where words begin
        self.first_word = np.searchsorted(self.words, np.concatenate(([0], at[ends])))  # of each text, and the end
        self.blocks = np.ndarray((self.n,), "<u8", self.bytes, strides=(1,))


def item_windows(text: bytes) -> list[tuple[bytes, int]]:
    words = FOLD[np.frombuffer(text, np.uint8)].tobytes().split()
    n = min(len(words), WINDOW)
    return [(b" " + b" ".join(words[i : i + n]) + b" ", n) for i in range(len(words) - n + 1)] if n else []


class ShiftTables:
    """One class of patterns: lengths of at least ``m`` bytes."""

    def __init__(self, patterns: list[bytes], ids: list[int]):
        self.m = min(map(len, patterns))
        self.width = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.width) - 1)
        self.bits = np.uint64(64 - 20)
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        heads = np.concatenate([heads, np.zeros((len(patterns), 8), np.uint8)], axis=1)
        self.shift = np.full(1 << 20, self.m - self.width + 1, np.int64)
        for j in range(self.m - self.width + 1):
            block = np.ascontiguousarray(heads[:, j : j + 8]).view("<u8")[:, 0] & self.mask
            np.minimum.at(self.shift, self._slot(block), self.m - self.width - j)
        last = np.ascontiguousarray(heads[:, self.m - self.width : self.m - self.width + 8]).view("<u8")[:, 0] & self.mask
        head = np.ascontiguousarray(heads[:, :8]).view("<u8")[:, 0] & self.mask
        key = last * MIX + head * MIX2
        order = np.argsort(key, kind="stable")
        self.keys, self.patterns, self.ids = key[order], [patterns[i] for i in order], [ids[i] for i in order]

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return ((block * MIX) >> self.bits).astype(np.int64)

    def search(self, buf: Buffer) -> tuple[np.ndarray, np.ndarray]:
        """(position, pattern id) of every occurrence."""
        end = buf.n - self.m + 1
        if end <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pos = np.arange(0, end, LANE, dtype=np.int64)
        stop = np.minimum(pos + LANE, end)
        found = []
        while len(pos):
            step = self.shift[self._slot(buf.blocks[pos + (self.m - self.width)] & self.mask)]
            found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            on = pos < stop
            if not on.all():
                pos, stop = pos[on], stop[on]
        at = np.concatenate(found)
        key = (buf.blocks[at + (self.m - self.width)] & self.mask) * MIX + (buf.blocks[at] & self.mask) * MIX2
        lo, hi = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        some = hi > lo
        text = buf.bytes[: buf.n].tobytes() if some.any() else b""
        hits = [
            (p, self.ids[k])
            for p, a, b in zip(at[some].tolist(), lo[some].tolist(), hi[some].tolist())
            for k in range(a, b)
            if text.startswith(self.patterns[k], p)
        ]
        out = np.array(hits, np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]


class PatternBlock:
    def __init__(self, items: list[tuple[str, bytes]]):
        seen: dict[tuple[bytes, int], set[str]] = {}
        for item, text in items:
            for window in item_windows(text):
                seen.setdefault(window, set()).add(item)
        self.items = [sorted(x) for x in seen.values()]
        self.length = np.array([n for _, n in seen], np.int64)
        classes: dict[int, tuple[list[bytes], list[int]]] = {}
        for i, (pattern, _) in enumerate(seen):
            own = classes.setdefault(min(len(pattern).bit_length(), 6), ([], []))  # from 32 bytes on one class
            own[0].append(pattern)
            own[1].append(i)
        self.tables = [ShiftTables(*x) for x in classes.values()]


def flag(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its ``keep`` columns) with the words, hit words and benchmark items of each document."""
    spark = docs.sparkSession
    taken = {c.lower() for c in OUTPUTS}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    blocks = _blocks(benchmark, text, item)
    shared = []
    for row in blocks.select("block").distinct().orderBy("block").toLocalIterator():
        items = [(r["item"], bytes(r["text"])) for r in blocks.where(F.col("block") == row["block"]).select("item", "text").collect()]
        shared.append(spark.sparkContext.broadcast(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = PatternBlock(shared[0].value) if len(shared) == 1 else None
        for batch in batches:
            for piece, texts in slices(batch, text):
                yield with_columns(piece, keep, _flag(texts, [ready] if ready else (PatternBlock(b.value) for b in shared)))

    fields = [docs.schema[c] for c in keep]
    schema = T.StructType(fields + T.StructType.fromDDL("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean").fields)
    need = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]
    return docs.select(*need).mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, text: str, item: str) -> DataFrame:
    """Items dealt by a hash into blocks whose expected size is half of ``BLOCK_BYTES``; (block, item, text)."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    n = 1 + 2 * int(total) // BLOCK_BYTES
    return cut_lineage(rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))))


def _flag(texts: list[bytes], blocks) -> dict[str, pa.Array]:
    buf = Buffer(texts)
    n_words = np.diff(buf.first_word)
    change = np.zeros(len(buf.words) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for block in blocks:
        for tables in block.tables:
            at, pattern = tables.search(buf)
            word = np.searchsorted(buf.words, at)
            np.add.at(change, word, 1)
            np.add.at(change, word + block.length[pattern], -1)
            text = np.searchsorted(buf.first_word, word, side="right") - 1
            for t, p in set(zip(text.tolist(), pattern.tolist())):
                items[t].update(block.items[p])
    hit = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
    n_hit = hit[buf.first_word[1:]] - hit[buf.first_word[:-1]]
    return {
        "n_words": pa.array(n_words, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(x) for x in items], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
        "contaminated": pa.array(n_hit > 0),
    }
