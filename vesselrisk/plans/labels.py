"""Public labels for ranked vessels (J12, E16, Q3): sanctioned positives by three paths, then a quota of negatives.

Works on any number of windows at once: every frame has ``window_id``, and quotas hold for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import top_k_per_group

# FIXED VALUES: list patterns that count as public evidence, and texts of the label rows.
PUBLIC_LISTS = ("%ofac%", "%un%", "%eu%")
EVIDENCE_URL = "https://data.opensanctions.org/datasets/latest/sanctions/entities.ftm.json"
POSITIVE_NOTE = "public sanctions overlap (integration OR match)"
NEGATIVE_SOURCE = "no_public_match_demo"
NEGATIVE_NOTE = "integration synthetic negative; analyst review required"
LOW_CONFIDENCE = 0.2
LABEL_COLUMNS = ["window_id", "mmsi", "imo", "label", "label_confidence", "evidence_source", "evidence_url", "notes"]


def vessel_name_key(name: Column) -> Column:
    """Q3: upper case, only A-Z, 0-9 and single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.trim(name)), "[^A-Z0-9 ]", ""), " +", " "))


def public_positives(sanctions: DataFrame, lists: tuple[str, ...] = PUBLIC_LISTS) -> DataFrame:
    """Sanctioned entities of public lists that can be matched: (mmsi, imo, name, entity_type, evidence_source), blanks for nulls."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    source = F.lower(blank("list_source"))
    listed = F.lit(False)
    for pattern in lists:
        listed = listed | source.like(pattern)
    named = (blank("name") != "") & (F.lower(blank("type")) == "vessel")
    return sanctions.where(listed & ((blank("mmsi") != "") | (blank("imo") != "") | named)).select(
        blank("mmsi").alias("mmsi"), blank("imo").alias("imo"), blank("name").alias("name"), blank("type").alias("entity_type"),
        F.coalesce("list_source", F.lit("unknown")).alias("evidence_source")).distinct()


def label_matches(watchlist: DataFrame, positives: DataFrame) -> DataFrame:
    """Watchlist rows that a positive meets by mmsi, imo or vessel name.

    A row met on several paths keeps the first of these in that order, there the first source by name: adds ``path``
    (1, 2, 3) and ``evidence_source``. Three equi-joins with one row a key on the positives' side, so nothing multiplies.
    """
    def best(keyed: DataFrame, path: int) -> DataFrame:
        return keyed.where("k <> ''").groupBy("k").agg(F.min("evidence_source").alias(f"source_{path}"))

    vessels = positives.where(F.lower("entity_type") == "vessel")
    sides = [
        (best(positives.select(F.col("mmsi").alias("k"), "evidence_source"), 1), F.coalesce("mmsi", F.lit(""))),
        (best(positives.select(F.col("imo").alias("k"), "evidence_source"), 2), F.coalesce("imo", F.lit(""))),
        (best(vessels.select(vessel_name_key(F.col("name")).alias("k"), "evidence_source"), 3), vessel_name_key(F.coalesce("vessel_name", F.lit("")))),
    ]
    out = watchlist
    for path, (side, key) in enumerate(sides, 1):
        side = side.withColumnRenamed("k", f"k_{path}")
        out = out.withColumn(f"own_{path}", key).join(side, (F.col(f"own_{path}") != "") & (F.col(f"own_{path}") == F.col(f"k_{path}")), "left")
    path = F.when(F.col("source_1").isNotNull(), 1).when(F.col("source_2").isNotNull(), 2).when(F.col("source_3").isNotNull(), 3)
    found = out.withColumn("path", path).where("path is not null")
    return found.select(*watchlist.columns, "path", F.coalesce("source_1", "source_2", "source_3").alias("evidence_source"))


def public_labels(watchlist: DataFrame, positives: DataFrame, max_known_cases: int, seeded: DataFrame | None = None) -> DataFrame:
    """The ``max_known_cases`` best-ranked positives of each window, then ``max(50 - p, 2 p, 20)`` negatives.

    Negatives are the first rows below ``LOW_CONFIDENCE`` that are no positives, in order of falling confidence. ``seeded``
    (mmsi) are test vessels that count as neither evidence nor recall. One row for each (window, mmsi, imo).
    """
    order = [F.col("confidence").desc(), F.col("mmsi"), F.col("imo")]
    rows = watchlist.select("window_id", "mmsi", "imo", "vessel_name", "confidence")
    found = label_matches(rows, positives).groupBy("window_id", "mmsi", "imo").agg(F.max_by(F.struct("evidence_source", "path", "confidence"), F.struct("confidence", -F.col("path"))).alias("x"))
    found = found.select("window_id", "mmsi", "imo", "x.evidence_source", "x.confidence")
    if seeded is not None:
        found = found.join(seeded.select("mmsi"), "mmsi", "left_anti")
    top = top_k_per_group(found, ["window_id"], order, max_known_cases)
    pos = top.select("window_id", "mmsi", "imo", F.lit("positive").alias("label"), F.lit("high").alias("label_confidence"), "evidence_source",
                     F.lit(EVIDENCE_URL).alias("evidence_url"), F.lit(POSITIVE_NOTE).alias("notes"))
    # The quota is at most max(50, 2 * max_known_cases), so the windows need a bounded number of their first rows each.
    n_pos = top.groupBy("window_id").agg(F.count("*").alias("p"))
    tail = rows.where(F.col("confidence") < LOW_CONFIDENCE).join(top.select("window_id", "mmsi"), ["window_id", "mmsi"], "left_anti")
    tail = tail.select("window_id", "mmsi", "imo", "confidence").groupBy("window_id", "mmsi", "imo").agg(F.max("confidence").alias("confidence"))
    first = top_k_per_group(tail, ["window_id"], order, max(50, 2 * max_known_cases))
    p = F.coalesce("p", F.lit(0))
    neg = first.join(n_pos, "window_id", "left").where(F.col("rk") <= F.greatest(50 - p, 2 * p, F.lit(20))).select(
        "window_id", "mmsi", "imo", F.lit("negative").alias("label"), F.lit("weak").alias("label_confidence"), F.lit(NEGATIVE_SOURCE).alias("evidence_source"),
        F.lit("").alias("evidence_url"), F.lit(NEGATIVE_NOTE).alias("notes"))
    return pos.unionByName(neg).select(*LABEL_COLUMNS)
