"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins. Boosting goes round the features: in each
step a shallow tree of one feature (at most four leaves) is fitted to the gradients and added
to that feature's lookup table. Then the feature pairs whose grids explain most of what is
left get tables of their own by the same rounds with trees over both features. A score is a
sum of table entries, looked up for a whole batch at a time.

The model is fitted on at most ``MAX_TRAIN`` labelled rows, those with the least hash of
their id, collected as numbers; all else covers all rows. Rows of an id with equal features are
one row with a weight. Ids with several texts may give up to ``2 * MAX_TRAIN`` such rows: one of each id
first, then a second of each, and so on, in an order fixed by the rows. Labels, language, source and
id are no features.

Defined results: null and empty texts have all features zero and a score like others; null ids are
not held out; null labels and labels without a document are left out, repeated labels count each; without both labels in training all scores are the share of ones (0.5 if there are none);
an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, with_columns

MAX_TRAIN = 20_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 50
N_PAIRS = 8
RATE = 0.1
MIN_HESSIAN = 2.0
FEATURES = (
    "log_words word_length upper digits punctuation symbols bars blanks lines non_ascii distinct same_as_before distinct_pairs repeated_lines short_words exclamations"
).split()
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
PUNCTUATION = b".,;:'\"()-"
SYMBOLS = b"#*$%&<>@^~_=+/\\{}[]"
NON_ASCII = bytes(range(128, 256))


def features(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    for row, t in zip(out, texts):
        words = t.split()
        n, size = len(words), len(t)
        if not n:
            continue
        share = lambda chars: (size - len(t.translate(None, chars))) / size  # noqa: E731, B023
        lines = [x for x in t.split(b"\n") if x.strip()]
        letters = size - t.count(b" ") - t.count(b"\n")
        row[:] = (
            np.log1p(n),
            letters / n,
            share(UPPER),
            share(DIGITS),
            share(PUNCTUATION),
            share(SYMBOLS),
            t.count(b"|") / n,
            t.count(b" ") / size,
            len(lines) / n,
            share(NON_ASCII),
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            len(set(zip(words, words[1:]))) / n,
            1 - len(set(lines)) / len(lines),
            sum(len(w) <= 3 for w in words) / n,
            t.count(b"!") / n,
        )
    return out


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, first bin to the right) of the best split of ordered bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    ok = (hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN)
    if not ok.any():
        return 0.0, 0
    gain = np.where(ok, gl**2 / (hl + 1) + gr**2 / (hr + 1), -np.inf) - g.sum() ** 2 / (h.sum() + 1)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree of depth two over ordered bins."""
    cuts = {0, len(g)}
    gain, at = _best_cut(g, h)
    if gain > 0:
        cuts.add(at)
        for a, b in ((0, at), (at, len(g))):
            more, inner = _best_cut(g[a:b], h[a:b])
            if more > 0:
                cuts.add(a + inner)
    ends = sorted(cuts)
    sums = np.add.reduceat(g, ends[:-1]), np.add.reduceat(h, ends[:-1])
    return np.repeat(-sums[0] / (sums[1] + 1), np.diff(ends))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of the best split of a grid into four quadrants, and its gain."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quadrants = []
    for c in (gc, hc):
        a = c[:-1, :-1]
        left, top, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        quadrants.append(np.stack([a, left - a, top - a, all_ - left - top + a]))
    gain = (quadrants[0] ** 2 / (quadrants[1] + 1)).sum(0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = -quadrants[0][:, i, j] / (quadrants[1][:, i, j] + 1)
    rows, cols = np.arange(g.shape[0]) > i, np.arange(g.shape[1]) > j
    return value[(2 * rows[:, None] + cols[None, :]).astype(int)], float(gain[i, j])


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: np.ndarray | None = None
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        if self.tables is not None and len(x):
            b = self.bins(x)
            z += self.tables[np.arange(x.shape[1]), b].sum(axis=1)
            for (i, j), grid in zip(self.pairs, self.grids):
                z += grid[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _quantiles(values: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """As ``np.quantile`` of the values, each repeated by its weight."""
    if (w == 1).all():
        return np.quantile(values, at)
    order = np.argsort(values, kind="stable")
    ends = np.cumsum(w[order])
    place = at * (ends[-1] - 1)
    low, high = (values[order][np.searchsorted(ends, f(place), side="right")] for f in (np.floor, np.ceil))
    return low + (high - low) * (place - np.floor(place))


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Model:
    w = np.ones(len(y)) if w is None else w
    share = float(np.average(y, weights=w)) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Model(float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)))
    model = Model(float(np.log(share / (1 - share))))
    model.edges = [np.unique(_quantiles(x[:, f], w, np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    b, n = model.bins(x), x.shape[1]
    model.tables = np.zeros((n, BINS))
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return w * (p - y), w * p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, f], g, BINS), np.bincount(b[:, f], h, BINS))
            model.tables[f] += step
            z += step[b[:, f]]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(b[:, i] * BINS + b[:, j], v, BINS * BINS).reshape(BINS, BINS)

    g, h = slopes()
    gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i, j in combinations(range(n), 2)), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:N_PAIRS]]
    model.grids = [np.zeros((BINS, BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            model.grids[k] += step
            z += step[b[:, i], b[:, j]]
    return model


def held_out(doc_id: Column) -> Column:
    """A third of the ids, by crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_TRAIN) -> Model:
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    known = known.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                x = features(texts)
                cols = {"x": pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))}
                yield with_columns(piece, ["id", "y"], cols)

    # At most max_rows labels; a document that is there twice has twice the weight.
    found = rows.select("id", "text", "y").mapInArrow(run, T.StructType([rows.schema["id"], *T.StructType.fromDDL("y double, x array<double>")]))
    folded = found.groupBy("id", "y", "x").agg(F.count("*").alias("w"))
    of_id = Window.partitionBy("id").orderBy(F.xxhash64("x", "y"), "x", "y")
    ranked = folded.withColumn("k", F.row_number().over(of_id)).where(F.col("k") <= 2 * max_rows)
    got = ranked.orderBy("k", F.xxhash64("id"), "id").limit(2 * max_rows).select("y", "x", "w").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort((got["w"].to_numpy(), *x.T, got["y"].to_numpy()))  # the order of rows must not matter
    return fit(x[order], (got["y"].to_numpy() >= 0.5).astype(float)[order], got["w"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of all documents with ``held_out``, ``score`` and ``predicted``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("held_out", "score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in slices(batch, "text_to_score"):
                yield with_columns(piece, keep, {"score": pa.array(model.score(features(texts)))})

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    scored = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("text_to_score")).mapInArrow(run, schema)
    return scored.select(*[F.col(f"`{c}`") for c in keep], held_out(F.col(f"`{doc_id}`")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
