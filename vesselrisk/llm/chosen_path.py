"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct ``SHINGLE``-word shingles; documents with equal sets are one
record. A record carries ``N_MINHASH`` minwise values of its set.

1. Each of ``TREES`` independent trees starts with all records. A node picks a few of the
   minwise positions by a hash of its own; a record goes on to the child of each picked position and
   the record's value there. The root picks two positions, a deeper node one, or two with
   probability ``SECOND``, so similar records keep meeting while others part, and rows do not grow.
2. Nodes of at most ``SMALL`` records are compared exhaustively by their minwise values. Of the pairs that
   agree in ``AGREE`` positions or more (a pair at the threshold agrees in 109 of 128 on average, with a
   deviation of 4; two bits of each value are compared), a spanning forest by agreement goes on to the check first.
3. Nodes whose records are already of one component end: their links could not join anything further. In
   a larger node with at most ``SMALL`` records outside its largest component, these are compared exhaustively with
   blocks of the component. In any other larger node all records are compared with one of them, and it branches on.
4. Candidates are confirmed on the full sets: 100 * intersection >= ``PERCENT`` * union. Confirmed
   links are contracted to components after each level. In the end the other pairs of compared nodes that are
   still in different components are confirmed inside the node's task, where each such record's set comes once, so no
   candidate between different components is left out and nothing emits all pairs of a group.

A record's nodes of a level follow from its minwise values and the large nodes above, so no level writes the records again.

A pair at the threshold stays together in a tree's first level with probability 0.96 and over five levels with about 0.7;
six trees lose it with probability under 1e-8 and 1e-3, a more similar one far less. Records that are linked to
several others of their group have as many chances more. Shingles are compared by 64 bits of hash, sets of documents by 128.

Defined results: null texts, and texts without words, have the empty set and are linked with nothing; fewer words than
``SHINGLE`` make one shingle. Null ids may be in a group but are its least id only if all are null. Repeated rows are members
of one group; an empty table gives an empty one; input columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns
from .common import shared_path, written
from .components import components
from .simhash import LOWER, Roots

SHINGLE = 4
PERCENT = 80
N_MINHASH = 128
AGREE = 94
TREES = 6
SMALL = 512
SECOND = 0.25
DEEP = 16  # from this level on small nodes may be twice as large with each level, so that the recursion ends
ROWS_PER_TASK = 20_000  # of slim rows whose number is known
KNOWN_BYTES = 8 << 20  # record ids are broadcast up to this size
SEED = 13
MIX = np.uint64(0x9E3779B97F4A7C15)
FACTORS = np.random.default_rng(SEED).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MINWISE = np.random.default_rng(SEED + 1).integers(1, 1 << 63, N_MINHASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


def shingle_set(text: bytes, hashes: dict, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; equal runs of words have equal hashes in any document."""
    words = text.translate(LOWER).split()  # splits at space and the bytes 9 to 13
    if not words:
        return np.empty(0, np.uint64)
    k = min(shingle, len(words))
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        total = mixed(total * FACTORS[i % len(FACTORS)] + w[i : len(w) - k + 1 + i])
    return np.unique(total)


def minwise(own: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``N_MINHASH`` multiplications (upper 32 bits)."""
    out = np.full(N_MINHASH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(own), 2048):
        np.minimum(out, ((own[i : i + 2048, None] * MINWISE) >> np.uint64(32)).min(axis=0).astype(np.uint32), out=out)
    return out


def with_sets(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns, the text, ``n_shingles``, ``k1`` and ``k2`` (128 bits of the set), ``sig`` (16 bits of its minwise values) and ``low`` (two bits of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, text):
                hashes, done = _WordHashes(), {}
                for t in texts:
                    if t not in done:
                        own = shingle_set(t, hashes, shingle)
                        raw = own.tobytes()
                        keys = (xxhash.xxh64_intdigest(raw, 1), xxhash.xxh64_intdigest(raw, 2)) if len(own) else (0, 0)
                        least = minwise(own) if len(own) else None
                        done[t] = (len(own), *keys, *((None, None) if least is None else (least.astype(np.uint16).tobytes(), two_bits(least))))
                n, k1, k2, sig, low = zip(*[done[t] for t in texts])
                signed = lambda k: pa.array(np.array(k, np.uint64).view(np.int64))
                new = {"n_shingles": pa.array(n, pa.int64()), "k1": signed(k1), "k2": signed(k2), "sig": pa.array(sig, pa.binary()), "low": pa.array(low, pa.binary())}
                yield with_columns(piece, [*keep, text], new)

    own = [T.StructField("n_shingles", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("low", T.BinaryType())]
    schema = T.StructType([docs.schema[c] for c in [*keep, text]] + own)
    return docs.select(*[F.col(f"`{c}`") for c in [*keep, text]]).mapInArrow(run, schema)


def two_bits(least: np.ndarray) -> bytes:
    """The last two bits of each value, 32 values in 64 bits."""
    return ((least & 3).astype(np.uint8).reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def signatures(column: pa.Array, dtype=np.uint16) -> np.ndarray:
    """Binary minwise values as a matrix with a row a record."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def n_agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions with equal bits, row by row; two bits a position."""
    d = x ^ y
    return N_MINHASH - np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)


def children(node: np.ndarray, of: np.ndarray, sig: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(child, row of ``sig``) of all rows (node, row of ``sig``) of this level."""
    pick = mixed(node * MIX + np.uint64(2 * level + 1))
    first = (pick % np.uint64(N_MINHASH)).astype(np.int64)
    second = (first + 1 + ((pick >> np.uint64(16)) % np.uint64(N_MINHASH - 1)).astype(np.int64)) % N_MINHASH
    two = np.full(len(node), True) if level == 0 else (pick >> np.uint64(40)).astype(np.float64) < SECOND * 2.0**24
    rows = np.concatenate([np.arange(len(node)), np.nonzero(two)[0]])
    position = np.concatenate([first, second[two]])
    value = sig[of[rows], position].astype(np.uint64)
    return mixed((node[rows] ^ mixed(value * MIX + position.astype(np.uint64))) + np.uint64(level)), of[rows]


def _branch(level: int, trees: range, larges: list[np.ndarray], last: bool):
    """Rows (node, rec, root, size, sig, low) to those of the nodes below: a level, and one more under the large nodes of each in ``larges``.

    The last rows are without ``sig``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [1, 2, 3, 5] if last else [1, 2, 3, 4, 5]
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 12):
                b = batch.slice(start, 1 << 12)
                node, sig, of = np.asarray(b.column(0)).view(np.uint64), signatures(b.column(4)), np.arange(b.num_rows)
                if level == 0:  # a root a tree
                    roots = mixed(np.array(trees, np.uint64) + np.uint64(1))
                    node, of = np.tile(roots, len(of)), np.repeat(of, len(roots))
                node, of = children(node, of, sig, level)
                for deeper, ids in enumerate(larges, level + 1):
                    on = ids[np.minimum(np.searchsorted(ids, node), len(ids) - 1)] == node
                    node, of = children(node[on], of[on], sig, deeper)
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), *[b.column(c).take(at) for c in held]], names=["node", *[b.schema.names[c] for c in held]])

    return run


def agreeing(node: np.ndarray, root: np.ndarray, sig: np.ndarray, size: np.ndarray, percent: int, least: int = AGREE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, agreeing positions) of all pairs within a node, between components and of sizes that may be similar; rows are sorted by node."""
    found = []
    a = np.arange(len(node) - 1)
    step = 1
    while len(a):
        a = a[a + step < len(node)]
        a = a[node[a] == node[a + step]]
        low, high = np.minimum(size[a], size[a + step]), np.maximum(size[a], size[a + step])
        other = a[(root[a] != root[a + step]) & (100 * low >= percent * high)]
        for i in range(0, len(other), 1 << 14):
            x = other[i : i + (1 << 14)]
            n = n_agree(sig[x], sig[x + step])
            on = n >= least
            found.append((x[on], x[on] + step, n[on]))
        step += 1
    return tuple(np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found) if found else ((), (), ())))


def forest(rec: np.ndarray, node: np.ndarray, root: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of the pairs that span each node's components, those of most agreement first."""
    _, place = np.unique(np.stack([node.view(np.int64), root]), axis=1, return_inverse=True)
    place = place.reshape(-1)  # (node, component)
    roots, chosen = Roots(int(place.max(initial=-1)) + 1), []
    order = np.lexsort((rec[b], rec[a], -n))  # the rank makes choices unique, so they make no circle
    left, right, alive = place[a[order]], place[b[order]], np.arange(len(order))
    while len(alive):
        x, y = roots.of[left[alive]], roots.of[right[alive]]
        on = x != y
        alive, x, y = alive[on], x[on], y[on]
        best = np.full(len(roots.of), len(order))
        np.minimum.at(best, x, alive)
        np.minimum.at(best, y, alive)
        take = np.unique(best[best < len(order)])
        chosen.append(take)
        roots.join(left[take], right[take])
    return order[np.concatenate(chosen)] if chosen else np.empty(0, np.int64)


def by_node(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14, most: int = 32 << 20) -> Iterator[pa.Table]:
    """Rows that come sorted by node as tables of whole nodes, a buffer at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 12):
            held.append(batch.slice(at, 1 << 12))
            if sum(b.num_rows for b in held) < rows and sum(b.get_total_buffer_size() // max(1, len(held)) for b in held) < most:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            node = t.column("node").to_numpy()
            other = np.nonzero(node != node[-1])[0]
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield t.slice(0, cut).combine_chunks()
            held = t.slice(cut).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _pairs(t: pa.Table, percent: int) -> tuple[np.ndarray, ...]:
    node, rec, root, size = (t.column(c).to_numpy() for c in ("node", "rec", "root", "size"))
    return node, rec, root, *agreeing(node, root, signatures(t.column("low").combine_chunks(), np.uint64), size, percent)


def _candidates(percent: int):
    """Rows (node, rec, root, size, low), sorted by node, to each node's pairs that span its components, and to the records with any other candidate.

    ``u`` and ``v`` are a pair, or ``v`` is null and ``u`` a record of ``node``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_node(batches):
            node, rec, root, a, b, n = _pairs(t, percent)
            if not len(a):
                continue
            on = forest(rec, node, root, a, b, n)
            both = np.unique(np.stack([np.minimum(rec[a[on]], rec[b[on]]), np.maximum(rec[a[on]], rec[b[on]])]), axis=1)
            other = np.ones(len(a), bool)
            other[on] = False
            own = np.unique(np.concatenate([a[other], b[other]]))
            u, v = np.concatenate([both[0], rec[own]]), np.concatenate([both[1], rec[own]])
            of_pair = np.arange(len(u)) < both.shape[1]
            where = np.concatenate([np.zeros(both.shape[1], np.int64), node[own]])
            yield pa.RecordBatch.from_arrays([pa.array(where, mask=of_pair), pa.array(u), pa.array(v, mask=~of_pair)], names=["node", "u", "v"])

    return run


def similar(x: bytes, y: bytes, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes as bytes."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    low, high = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(low) < percent * len(high):
        return False
    place = np.minimum(np.searchsorted(high, low), len(high) - 1)
    both = int((high[place] == low).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm_nodes(percent: int):
    """Rows (node, rec, root, size, low, own), sorted by node, to links that span what is linked within a buffer of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_node(batches):
            _, rec, root, a, b, n = _pairs(t, percent)
            own = t.column("own").combine_chunks()
            top: dict[int, int] = {}

            def find(r: int) -> int:
                while top.setdefault(r, r) != r:
                    top[r] = top[top[r]]
                    r = top[r]
                return r

            u, v = [], []
            for i in np.argsort(-n, kind="stable").tolist():
                x, y = find(int(root[a[i]])), find(int(root[b[i]]))
                if x != y and similar(own[int(a[i])].as_py(), own[int(b[i])].as_py(), percent):
                    top[x] = y
                    u.append(min(rec[a[i]], rec[b[i]]))
                    v.append(max(rec[a[i]], rec[b[i]]))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rec, low, centre, centre's low) to the pairs that agree."""
    for b in batches:
        if not b.num_rows:
            continue
        rec, centre = np.asarray(b.column(0)), np.asarray(b.column(2))
        on = n_agree(signatures(b.column(1), np.uint64), signatures(b.column(3), np.uint64)) >= AGREE
        u, v = np.minimum(rec, centre)[on], np.maximum(rec, centre)[on]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _sets(shingle: int):
    """Rows (rec, text) to (rec, own): the sorted hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "text", 1 << 20):
                hashes = _WordHashes()
                own = [shingle_set(t, hashes, shingle).tobytes() for t in texts]
                yield with_columns(piece, ["rec"], {"own": pa.array(own, pa.binary())})

    return run


def _confirm(percent: int):
    """Rows (u, v, set of u, set of v) to those that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                b = batch.slice(at, 64)
                on = [similar(x, y, percent) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(on, pa.bool_())], names=["u", "v", "linked"])

    return run


def sized(rows: DataFrame, n: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """As many tasks as ``n`` rows need: few rows cost few shuffle files, more get more tasks."""
    return rows.coalesce(max(1, -(-n // per_task)))


class Join:
    """The state of one join: records (rec, size, sig, low), their texts, checked pairs and the components of the links so far."""

    def __init__(self, records: DataFrame, texts: DataFrame, shingle: int, percent: int):
        self.spark, self.records, self.texts = records.sparkSession, records, texts
        self.shingle, self.percent = shingle, percent
        self.partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.checked = self.spark.createDataFrame([], "u long, v long, linked boolean")
        self.roots = self.spark.createDataFrame([], "rec long, root long")
        self.n_roots = 0

    def with_root(self, rows: DataFrame) -> DataFrame:
        roots = F.broadcast(self.roots) if self.n_roots * 16 <= KNOWN_BYTES else self.roots
        return rows.join(roots, "rec", "left").withColumn("root", F.coalesce("root", "rec"))

    def sets_of(self, ids: DataFrame, few: bool) -> DataFrame:
        wanted = self.texts.join(F.broadcast(ids) if few else ids, "rec", "left_semi")
        return written(wanted.select("rec", "text").mapInArrow(_sets(self.shingle), "rec long, own binary"), "full-sets")

    def contract(self, links: DataFrame) -> None:
        """``links`` (u, v), u < v, join their components."""
        old = self.roots.select(F.col("rec").alias("u"), F.col("root").alias("v"))
        edges = old.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        self.roots = components(edges, ROWS_PER_TASK).select(F.col("node").alias("rec"), "root")
        self.n_roots = self.roots.count()

    def check(self, pairs: DataFrame) -> None:
        """Confirms new pairs on the full sets and contracts what they link."""
        new = written(pairs.distinct().join(self.checked.select("u", "v"), ["u", "v"], "left_anti"), "pairs")
        n = new.count()
        if not n:
            return
        new = sized(new, n)
        sets = sized(self.sets_of(new.select(F.explode(F.array("u", "v")).alias("rec")).distinct(), 2 * n * 8 <= KNOWN_BYTES), 2 * n, ROWS_PER_TASK // 20)
        one = new.join(sets.select(F.col("rec").alias("u"), F.col("own").alias("own_u")), "u")
        both = one.join(sets.select(F.col("rec").alias("v"), F.col("own").alias("own_v")), "v")
        done = written(both.select("u", "v", "own_u", "own_v").mapInArrow(_confirm(self.percent), "u long, v long, linked boolean"), "confirmed")
        done = sized(done, n)
        self.checked = self.checked.unionByName(done)
        self.contract(done.where("linked"))

    def nodes_at(self, larges: list[tuple[DataFrame, np.ndarray | None]]) -> DataFrame:
        """(node, rec, root, size, low): all records in the nodes under the large nodes of each level so far.

        Large nodes come as a table, and sorted if they are known to be few; then levels are walked in one step, without a join.
        """
        rows = self.with_root(self.records).select(F.lit(0).cast("long").alias("node"), "rec", "root", "size", "sig", "low")
        start, walked = 0, []
        for level, (table, ids) in enumerate(larges):
            if ids is not None:
                walked.append(ids)
                continue
            schema = "node long, rec long, root long, size long, sig binary, low binary"
            below = rows.mapInArrow(_branch(start, range(0 if start else TREES), walked, False), schema)
            rows = below.join(table, "node", "left_semi").select("node", "rec", "root", "size", "sig", "low")
            start, walked = level + 1, []
        return rows.mapInArrow(_branch(start, range(0 if start else TREES), walked, True), "node long, rec long, root long, size long, low binary")

    def run(self) -> None:
        rest = self.descend()
        rooted = self.with_root(rest)
        open_nodes = rooted.groupBy("node").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 < r2").select("node")
        rest = written(rest.join(open_nodes, "node"), "rest")
        n = rest.count()
        if not n:
            return
        sets = self.sets_of(rest.select("rec").distinct(), n * 8 <= KNOWN_BYTES)
        full = self.with_root(rest).join(sets, "rec").select("node", "rec", "root", "size", "low", "own")
        dealt = full.repartition(self.partitions, "node").sortWithinPartitions("node", "rec")
        self.contract(written(dealt.mapInArrow(_confirm_nodes(self.percent), "u long, v long"), "links"))

    def descend(self) -> DataFrame:
        """Branches until no large node is left; the records (node, rec, size, low) of compared nodes with pairs that are not checked yet."""
        larges, rest = [], []
        level = 1
        while True:
            limit = SMALL * 2 ** max(0, level - DEEP)
            rows = self.nodes_at(larges)
            big = written(rows.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > limit), "big-nodes")
            if n_big := big.count():
                few = n_big * 64 <= KNOWN_BYTES
                in_big = rows.join(F.broadcast(big) if few else big, "node")
                one = F.min(F.struct(F.xxhash64("rec", "node").alias("h"), "rec", "low")).alias("one")
                per = in_big.groupBy("node", "root").agg(F.count("*").alias("c"), one)
                main = F.max(F.struct("c", "root")).alias("main")
                nodes = per.groupBy("node").agg(F.sum("c").alias("n"), F.count("*").alias("parts"), main, F.min("one").alias("one"))
                others = F.col("n") - F.col("main.c")
                kind = F.when(F.col("parts") == 1, "done").when(others <= limit, "uneven").otherwise("large")
                nodes = nodes.select("node", "n", F.col("main.root").alias("main"), F.col("one.rec").alias("centre"), F.col("one.low").alias("centre_low"), kind.alias("kind"))
                nodes = written(nodes, "nodes")
                few_of = lambda d: F.broadcast(d) if few else d
                compared = blocks(rows.join(few_of(nodes.select("node", "n", "main", "kind")), "node", "left"), limit)
                large = nodes.where("kind = 'large'")
                deeper = not large.isEmpty()
            else:
                compared, deeper = rows, False
            dealt = compared.repartition(self.partitions, "node").sortWithinPartitions("node", "rec")
            found = written(dealt.mapInArrow(_candidates(self.percent), "node long, u long, v long"), "found")
            rest.append(found.where("v is null").select("node", F.col("u").alias("rec")))
            pairs = found.where("v is not null").select("u", "v")
            if deeper:
                starred = rows.join(few_of(large), "node").where("rec <> centre and root <> centre").select("rec", "low", "centre", "centre_low")
                pairs = pairs.unionByName(starred.mapInArrow(_star, "u long, v long"))
            self.check(pairs)
            if not deeper:
                break
            ids = np.sort(np.array([r["node"] for r in large.select("node").collect()], np.int64).view(np.uint64)) if few else None
            larges.append((large.select("node"), ids))
            level += 1
        every = rest[0]
        for more in rest[1:]:
            every = every.unionByName(more)
        return every.join(self.records.select("rec", "size", "low"), "rec").select("node", "rec", "size", "low")


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (node, rec, root, size, low, n, main, kind) of nodes to be compared, without a kind as they are.

    An uneven node has one large component and few other records: the component's records are dealt out to blocks
    of about ``size``; the others go to each of these. Rows of nodes of other kinds go.
    """
    n = F.ceil(F.col("n") / size).cast("int")
    own = F.array(F.pmod(F.xxhash64("rec"), n).cast("int"))
    every = F.sequence(F.lit(0), n - 1)
    block = F.when(F.col("kind").isNull(), F.array(F.lit(-1))).when(F.col("root") == F.col("main"), own).otherwise(every)
    dealt = rows.where("kind is null or kind = 'uneven'").select("node", "rec", "root", "size", "low", F.explode(block).alias("block"))
    return dealt.withColumn("node", F.when(F.col("block") < 0, F.col("node")).otherwise(F.xxhash64("node", "block"))).drop("block")


def near_dups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row for each document."""
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    path = shared_path(spark, "sets")
    with_sets(plain, ["doc_id"], "text", shingle).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    base = spark.read.parquet(path)  # written once: row numbers are the same for all uses
    key = ["n_shingles", "k1", "k2"]
    keyed = base.where("n_shingles > 0").groupBy(*key).agg(F.min("at").alias("rec"), F.min("doc_id").alias("least"))
    keyed = written(keyed, "keyed")
    recs = keyed.select(F.col("rec").alias("at"))
    if recs.count() * 8 <= KNOWN_BYTES:  # read where they are; else written apart
        chosen = base.join(F.broadcast(recs), "at", "left_semi").select(F.col("at").alias("rec"), F.col("n_shingles").alias("size"), "sig", "low")
    else:
        chosen = base.select("at", "n_shingles", "sig", "low").join(recs, "at", "left_semi").select(F.col("at").alias("rec"), F.col("n_shingles").alias("size"), "sig", "low")
        chosen = written(chosen, "records")
    join = Join(chosen, base.select(F.col("at").alias("rec"), "text"), shingle, percent)
    join.run()
    rooted = keyed.join(join.roots, "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component"))
    by_set = rooted.join(groups, "root").select(*key, "component")
    slim = base.select("doc_id", *key)
    linked = slim.join(by_set, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = linked.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).withColumnRenamed("doc_id", doc_id)
