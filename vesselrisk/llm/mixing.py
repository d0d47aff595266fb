"""Mixing sources to target weights, in DataFrame operations only.

Every row gets a hash-random key. Within a source the rows are ordered by that key
(keys are uniform, so equal key ranges are a range sort without sampling), and the
prefix sums of the sizes are built in two steps: sums per (source, key range), then
rows of the one range where the budget falls. Each source is cut at its exact
budget: the row at the cut gives only as many words as are left. A budget above the
source's size repeats the source in whole epochs first.

Only a slim table (source, key, size) is shuffled, and aggregated before that; what
comes back is one cut per source, which every document is compared with, so texts
are never shuffled and a hot source costs no more than its share.

The key depends on the row alone (id and text), so a second scan that is split otherwise gives the
same. Equal rows at a cut are written once with numbers and take turns; as they are equal, the
result does not depend on which of them comes first.

Defined results: null text has size 0; null source is a source of its own, last; null
ids are ids; an empty table gives an empty one; a mix of size 0 takes nothing; input
columns called like a result column are replaced; other columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, replaced, word_array

BROADCAST_SOURCES = 100_000
OUTPUTS = ["size", "source_size", "target", "budget", "taken", "epochs", "last"]


def n_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def random_key(seed: int, *cols: Column) -> Column:
    """60 bits of an MD5 over the given columns, not negative."""
    parts = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: list[float], max_epochs: int) -> DataFrame:
    """(source, source_size) with ``target``: the total shared by weight, no source above ``max_epochs`` times its size.

    Weights go round over the sources in code point order, null last. The sources that
    reach their cap are a prefix of the order by cap / weight, so prefix sums over one
    row per source give the common level of the others.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "w"
    ).over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    shared = (
        sizes.select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
        .withColumn("level", level)
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("w"))
    )
    free = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return shared.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(free * F.col("w")).alias("target"))


def _cut(slim: DataFrame, budgets: DataFrame, ranges: int) -> DataFrame:
    """Per source the key where the prefix sum of sizes passes ``rest``: (source, at, words left for the rows with that key, number of these rows)."""
    upto = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = slim.withColumn("range", F.floor(F.col("k") / F.lit(float((1 << 60) / ranges))))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("s"))
    falls = (
        sums.withColumn("upto", F.sum("s").over(upto.orderBy("range")))
        .join(budgets.withColumnRenamed("source", "b_source"), F.col("source").eqNullSafe(F.col("b_source")))
        .where("upto - s < rest and rest <= upto")
        .select(F.col("source").alias("f_source"), F.col("range").alias("f_range"), (F.col("rest") - F.col("upto") + F.col("s")).alias("rest"))
    )
    inside = ranged.join(falls, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("range") == F.col("f_range")))
    keys = inside.groupBy("source", "k").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.first("rest").alias("rest"))
    return (
        keys.withColumn("upto", F.sum("s").over(upto.orderBy("k")))
        .where("upto - s < rest and rest <= upto")
        .select("source", F.col("k").alias("at"), (F.col("rest") - F.col("upto") + F.col("s")).alias("left_over"), F.col("n").alias("ties"))
    )


def mix(
    docs: DataFrame,
    weights: list[float],
    max_epochs: int = 3,
    seed: int = 29,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    ranges: int | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``budget`` (the target in whole words), ``epochs``
    (whole times the row is taken), ``last`` (words of it in the last, cut epoch) and ``taken`` = epochs * size + last."""
    src, ident = F.col(f"`{source}`"), (F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    # Both depend on the row alone, so a second scan that is split otherwise gives the same.
    own = [n_words(F.col(f"`{text}`")).alias("size"), random_key(seed, *ident).alias("k")]
    slim = cut_lineage(docs.select(src.alias("source"), *own))
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    budget = F.round("target").cast("long")
    size1 = F.greatest(F.col("source_size"), F.lit(1))
    plan = cut_lineage(
        targets(totals.select("source", "source_size"), weights, max_epochs)
        .withColumn("budget", budget)
        .withColumn("epochs", F.floor(F.col("budget") / size1))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    ranges = ranges or max(1, math.isqrt(slim.count()))  # so many sums a source, and about so many rows in the range of its cut
    rest = plan.where("rest > 0").select("source", "rest")
    at = _cut(slim, rest, ranges)
    cuts = cut_lineage(
        plan.select(F.col("source").alias("c_source"), "source_size", "target", "budget", "epochs")
        .join(at.withColumnRenamed("source", "s1"), F.col("c_source").eqNullSafe(F.col("s1")), "left")
        .drop("s1")
    )
    # One row per source. So few are broadcast; more are joined as any other table.
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts
    keep = F.struct(*replaced(docs, OUTPUTS))
    rows = docs.select(keep.alias("row"), src.alias("source"), *own)
    # The row with the cut's very key gets the words that are left. There may be more rows with it: equal ones.
    last = F.when(F.col("at").isNull() | (F.col("k") > F.col("at")), F.lit(0)).when(F.col("k") < F.col("at"), F.col("size")).otherwise(F.least("left_over", "size"))
    joined = rows.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left")
    done = joined.withColumn("last", last.cast("long"))
    if not cuts.where("ties > 1").isEmpty():
        tied = F.coalesce((F.col("k") == F.col("at")) & (F.col("ties") > 1), F.lit(False))
        done = done.where(~tied).unionByName(_in_turn(joined.where(tied)))
    return done.select("row.*", "size", "source_size", "target", "budget", (F.col("epochs") * F.col("size") + F.col("last")).alias("taken"), "epochs", "last")


def _in_turn(tied: DataFrame) -> DataFrame:
    """Rows of a source with one key take turns until ``left_over`` is used up: adds ``last``.

    They are written once with their number; a source's numbers go on over the partitions.
    """
    placed = cut_lineage(tied.withColumn("id", F.monotonically_increasing_id())).withColumn("part", F.shiftright("id", 33))
    of_part = placed.groupBy("source", "part").count()  # a row a partition and source
    before = F.sum("count").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = of_part.select(F.col("source").alias("o_source"), F.col("part").alias("o_part"), F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "part").orderBy("id")) - 1
    numbered = placed.withColumn("inside", inside).join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
    left = F.col("left_over") - (F.col("before") + F.col("inside")) * F.col("size")
    return numbered.withColumn("last", F.greatest(F.least(left, F.col("size")), F.lit(0)).cast("long")).drop("id", "part", "inside", "o_source", "o_part", "before")
