"""R2: distributed ordered operations.

``Window.partitionBy(g).orderBy(x)`` over a large group pulls the group into
one task. Two replacements:

* ``top_k_per_group``: ``row_number() <= k`` which Spark plans as a partial
  ``WindowGroupLimit`` before the shuffle, so each group receives at most
  k rows per input partition.
* ``exclusive_prefix_sums``: range-partition by (group, order), sort within
  partitions, compute partition-local running sums in ``mapInPandas``, then add
  per-(partition, group) offsets derived from a tiny totals table
  (#partitions x #groups rows, equi-joined; no size is assumed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int, rank_col: str = "rk") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def exclusive_prefix_sums(
    df: DataFrame,
    group: str,
    order: str,
    values: list[str],
    ascending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over rows of the same group strictly before this row.

    Rows must be unique on (group, order). Order is ascending unless ``ascending=False``.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okey = F.col(order) if ascending else -F.col(order)
    keyed = df.withColumn("_ok", okey.cast("double"))
    ranged = keyed.repartitionByRange(n, group, "_ok").sortWithinPartitions(group, "_ok")
    fields = [T.StructField(f.name, f.dataType, True) for f in ranged.schema.fields]
    fields += [T.StructField("_pid", T.IntegerType())] + [T.StructField(f"cum_{v}", T.DoubleType()) for v in values]
    out_schema = T.StructType(fields)

    def local(it):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carry: dict = {v: {} for v in values}
        for pdf in it:
            if pdf.empty:
                continue
            pdf = pdf.copy()
            pdf["_pid"] = pid
            for v in values:
                col = pdf[v].astype("float64").fillna(0.0)
                incl = col.groupby(pdf[group], sort=False).cumsum()
                prev = pdf[group].map(carry[v]).astype("float64").fillna(0.0)
                pdf[f"cum_{v}"] = incl - col + prev
                last = (incl + prev).groupby(pdf[group], sort=False).last()
                carry[v].update(last.to_dict())
            yield pdf

    # Written once: the totals and the rows must come from the same ranges, whatever is lost or read again.
    local_df = cut_lineage(ranged.mapInPandas(local, out_schema))
    # Totals per (partition, group): at most #partitions x #groups rows.
    totals = local_df.groupBy("_pid", group).agg(
        *[F.sum(F.coalesce(F.col(v).cast("double"), F.lit(0.0))).alias(f"t_{v}") for v in values])
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", group, *[F.coalesce(F.sum(f"t_{v}").over(w), F.lit(0.0)).alias(f"o_{v}") for v in values])
    res = local_df.join(offsets, ["_pid", group], "left")
    return res.select(
        *[c for c in df.columns],
        *[(F.col(f"cum_{v}") + F.coalesce(F.col(f"o_{v}"), F.lit(0.0))).alias(f"cum_{v}") for v in values],
    )

