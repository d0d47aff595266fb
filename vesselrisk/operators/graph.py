"""Ownership / sanctions graph operators.

Nodes and edges are plain DataFrames with ``src_id``/``dst_id`` columns; hops
are equi-joins. Dimension-like inputs whose size is bounded by a code list
(countries, flags) are broadcast explicitly; everything else is left to AQE's
runtime size checks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage

NARROW = 12  # groups of a member whose subsets (2^12 at most) are counted; the count of members is the same beyond


@dataclass
class Graph:
    vessels: DataFrame          # mmsi, imo, name
    owned_by: DataFrame         # src_id (mmsi) -> dst_id (company)
    managed_by: DataFrame       # src_id (mmsi) -> dst_id (company)
    controlled_by: DataFrame    # src_id (company) -> dst_id (parent company)
    registered_in: DataFrame    # src_id (company) -> dst_id (country)
    registered_at: DataFrame    # src_id (company) -> dst_id (address)
    sanctioned_by: DataFrame    # src_id (mmsi | entity_id) -> dst_id (list_source)
    alias: DataFrame            # src_id (mmsi) -> dst_id (name)


def _edges(df: DataFrame) -> DataFrame:
    return df.select(F.col("src_id").cast("string"), F.col("dst_id").cast("string"))


def build_graph(
    vessel_meta: DataFrame,
    sanctions_entities: DataFrame,
    owned_by: DataFrame,
    managed_by: DataFrame,
    controlled_by: DataFrame,
    registered_in: DataFrame,
    registered_at: DataFrame,
) -> Graph:
    """Node and edge tables from the registry, sanctions and ownership inputs."""
    spark = vessel_meta.sparkSession
    vessels = vessel_meta.where(F.col("mmsi").isNotNull()).select(
        "mmsi", F.coalesce("imo", F.lit("")).alias("imo"), F.coalesce("name", F.lit("")).alias("name")
    ).dropDuplicates(["mmsi"])
    se = sanctions_entities
    # Vessel sanctions: id by mmsi, else by imo through the registry.
    sv = se.where(
        ((F.col("type") == "Vessel") | (F.col("mmsi").isNotNull() & (F.col("mmsi") != "")))
        & (F.col("mmsi").isNotNull() | F.col("imo").isNotNull())
    ).select(F.coalesce("mmsi", F.lit("")).alias("s_mmsi"), F.coalesce("imo", F.lit("")).alias("s_imo"), "list_source")
    imo_index = vessels.where(F.col("imo") != "").groupBy("imo").agg(F.min("mmsi").alias("imo_mmsi"))
    sv = sv.join(imo_index, sv.s_imo == imo_index.imo, "left").select(
        F.when(F.col("s_mmsi") != "", F.col("s_mmsi")).otherwise(F.col("imo_mmsi")).alias("src_id"),
        F.col("list_source").alias("dst_id"),
    ).where(F.col("src_id").isNotNull() & (F.col("src_id") != ""))
    sc = se.where(F.col("type").isin(*C.COMPANY_TYPES)).select(
        F.col("entity_id").alias("src_id"), F.col("list_source").alias("dst_id")
    )
    sanctioned_by = sv.unionByName(sc).dropDuplicates(["src_id", "dst_id"])
    company_flags = se.where(F.col("type").isin(*C.COMPANY_TYPES) & F.col("flag").isNotNull() & (F.col("flag") != "")).select(
        F.col("entity_id").alias("src_id"), F.col("flag").alias("dst_id")
    )
    reg_in = _edges(registered_in).unionByName(company_flags).distinct()
    empty = spark.createDataFrame([], "src_id string, dst_id string")
    # Edge tables are read by every graph feature: persist them once.
    keep = _persist
    return Graph(
        vessels=keep(vessels),
        owned_by=keep(_edges(owned_by)),
        managed_by=keep(_edges(managed_by)),
        controlled_by=keep(_edges(controlled_by)),
        registered_in=keep(reg_in),
        registered_at=keep(_edges(registered_at)),
        sanctioned_by=keep(sanctioned_by),
        alias=empty,
    )


def _persist(df: DataFrame) -> DataFrame:
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _per_vessel(g: Graph, df: DataFrame, col: str, default) -> DataFrame:
    """Left-join a per-vessel result onto all vessel nodes with a default."""
    return g.vessels.select("mmsi").join(df, "mmsi", "left").select(
        "mmsi", F.coalesce(F.col(col), F.lit(default)).alias(col)
    )


def name_owner_changes(g: Graph) -> DataFrame:
    """name_changes_2y (ALIAS rows), owner_changes_2y (OWNED_BY rows), flag_changes_2y = 0."""
    names = g.alias.groupBy(F.col("src_id").alias("mmsi")).agg(F.count(F.lit(1)).alias("name_changes_2y"))
    owners = g.owned_by.groupBy(F.col("src_id").alias("mmsi")).agg(F.count(F.lit(1)).alias("owner_changes_2y"))
    return (
        g.vessels.select("mmsi").join(names, "mmsi", "left").join(owners, "mmsi", "left")
        .select(
            "mmsi",
            F.lit(0).cast("long").alias("flag_changes_2y"),
            F.coalesce("name_changes_2y", F.lit(0)).alias("name_changes_2y"),
            F.coalesce("owner_changes_2y", F.lit(0)).alias("owner_changes_2y"),
        )
    )


def company_chain_length(controlled_by: DataFrame, max_hops: int = C.OWNERSHIP_MAX_CONTROL_HOPS) -> DataFrame:
    """Per company, the longest CONTROLLED_BY walk from it, capped at ``max_hops``.

    L_0 = 0; L_k(c) = max over edges c->p of 1 + L_{k-1}(p). A cycle keeps the
    walk alive, so cyclic companies reach the cap. Runs on the company graph
    only (small next to vessel tables); each round is a join + groupBy.
    """
    edges = controlled_by.select(F.col("src_id").alias("c"), F.col("dst_id").alias("p")).distinct()
    nodes = edges.select(F.col("c")).union(edges.select(F.col("p").alias("c"))).distinct()
    level = nodes.withColumn("L", F.lit(0))
    for _ in range(max_hops):
        step = edges.join(level.withColumnRenamed("c", "p"), "p", "left").groupBy("c").agg(
            F.max(F.coalesce(F.col("L"), F.lit(0)) + 1).alias("L_new")
        )
        level = nodes.join(step, "c", "left").select("c", F.coalesce("L_new", F.lit(0)).alias("L"))
    return level


def ownership_depth(g: Graph, max_hops: int = C.OWNERSHIP_MAX_CONTROL_HOPS) -> DataFrame:
    """0 without owner, else 1 + the longest control walk (<= 5) from any owner."""
    chain = company_chain_length(g.controlled_by, max_hops)
    own = g.owned_by.select(F.col("src_id").alias("mmsi"), F.col("dst_id").alias("c")).distinct()
    depth = own.join(chain, "c", "left").groupBy("mmsi").agg(
        (F.lit(1) + F.max(F.coalesce("L", F.lit(0)))).alias("ownership_depth")
    )
    return _per_vessel(g, depth, "ownership_depth", 0)


def high_risk_flag_ratio(g: Graph) -> DataFrame:
    """Share of distinct owner countries that are high-risk flags."""
    vc = (
        g.owned_by.select(F.col("src_id").alias("mmsi"), F.col("dst_id").alias("company"))
        .join(g.registered_in.select(F.col("src_id").alias("company"), F.col("dst_id").alias("country")), "company")
        .select("mmsi", "country").distinct()
    )
    r = vc.groupBy("mmsi").agg(
        (F.count_if(F.col("country").isin(*C.HIGH_RISK_FLAGS)) / F.count(F.lit(1))).alias("high_risk_flag_ratio")
    )
    return _per_vessel(g, r, "high_risk_flag_ratio", 0.0)


def vessel_companies(g: Graph) -> DataFrame:
    return (
        g.owned_by.unionByName(g.managed_by)
        .select(F.col("src_id").alias("mmsi"), F.col("dst_id").alias("company")).distinct()
    )


def sanctions_distance(g: Graph) -> DataFrame:
    """0 vessel listed, 1 owner/manager listed, 2 parent listed, 3 grandparent listed, else 99."""
    sanctioned = g.sanctioned_by.select(F.col("src_id").alias("id")).distinct()
    cb = g.controlled_by.select(F.col("src_id").alias("c"), F.col("dst_id").alias("p"))
    lvl1 = sanctioned.select(F.col("id").alias("company"), F.lit(1).alias("lvl"))
    parents = cb.join(sanctioned, cb.p == sanctioned.id, "left_semi").select(F.col("c").alias("p2")).distinct()
    lvl2 = parents.select(F.col("p2").alias("company"), F.lit(2).alias("lvl"))
    lvl3 = cb.join(parents, cb.p == parents.p2, "left_semi").select(F.col("c").alias("company"), F.lit(3).alias("lvl"))
    company_level = lvl1.unionByName(lvl2).unionByName(lvl3).groupBy("company").agg(F.min("lvl").alias("lvl"))
    via = vessel_companies(g).join(company_level, "company").groupBy("mmsi").agg(F.min("lvl").alias("lvl"))
    direct = g.vessels.select("mmsi").join(sanctioned, F.col("mmsi") == F.col("id"), "left_semi").select(
        "mmsi", F.lit(0).alias("lvl0")
    )
    return (
        g.vessels.select("mmsi").join(direct, "mmsi", "left").join(via, "mmsi", "left")
        .select("mmsi", F.coalesce("lvl0", "lvl", F.lit(C.MAX_HOPS)).cast("long").alias("sanctions_distance"))
    )


def direct_sanctions_fallback(dist: DataFrame, sanctions_entities: DataFrame) -> DataFrame:
    """Distance 99 -> 0 when the mmsi is listed directly; other values untouched."""
    listed = sanctions_entities.where(F.col("mmsi").isNotNull() & (F.col("mmsi") != "")).select(
        F.col("mmsi").alias("_listed")
    ).distinct()
    j = dist.join(listed, dist.mmsi == listed._listed, "left")
    return j.select(
        *[c for c in dist.columns if c != "sanctions_distance"],
        F.when((F.col("sanctions_distance") == C.MAX_HOPS) & F.col("_listed").isNotNull(), F.lit(0).cast("long"))
        .otherwise(F.col("sanctions_distance")).alias("sanctions_distance"),
    )


def _subsets(groups):
    """All non-empty subsets of an array column, each in the array's order."""
    empty = F.array().cast("array<string>")
    all_sets = F.aggregate(
        groups, F.array(empty), lambda acc, g: F.concat(acc, F.transform(acc, lambda s: F.concat(s, F.array(g)))),
    )
    return F.filter(all_sets, lambda s: F.size(s) > 0)


def union_sizes(membership: DataFrame, weight: DataFrame | None = None, narrow: int = NARROW) -> DataFrame:
    """Per member v: |U_{g in G(v)} M(g)| and the weight sum over that union.

    membership: (v, g) rows; weight: (v, w) with w in {0, 1} (missing -> 0).
    Members with the same group set ("signature") are interchangeable. Signatures of
    at most ``narrow`` (1 or more) groups are counted by inclusion and exclusion over their own
    subsets: each subset's count is one partial aggregation, and no two signatures
    meet, however many share a hub. The few signatures with more groups have too many
    subsets and are matched with the signatures of their groups instead.
    """
    mem = membership.select("v", F.col("g").cast("string").alias("g")).distinct()
    if weight is None:
        mem = mem.withColumn("w", F.lit(0))
    else:
        mem = mem.join(weight.groupBy("v").agg(F.max("w").alias("w")), "v", "left").withColumn("w", F.coalesce("w", F.lit(0)))
    per_v = mem.groupBy("v").agg(F.array_sort(F.collect_set("g")).alias("gs"), F.first("w").alias("w"))
    sigs = per_v.groupBy("gs").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("ws"))
    few, many = sigs.where(F.size("gs") <= narrow), sigs.where(F.size("gs") > narrow)

    subsets = few.select("gs", "n", "ws", F.explode(_subsets(F.col("gs"))).alias("s"))
    counts = subsets.groupBy("s").agg(F.sum("n").alias("cn"), F.sum("ws").alias("cw"))
    sign = F.when(F.size("s") % 2 == 1, 1).otherwise(-1)
    parts = subsets.select("gs", "s").join(counts, "s").select("gs", (sign * F.col("cn")).alias("u"), (sign * F.col("cw")).alias("us"))

    wide = many.select(F.col("gs").alias("gs2"), "n", "ws", F.explode("gs").alias("g"))
    in_one = few.where(F.size("gs") == 1).select("gs", F.col("gs")[0].alias("g")).join(
        wide.groupBy("g").agg(F.sum("n").alias("u"), F.sum("ws").alias("us")), "g").select("gs", "u", "us")
    in_more = sigs.where(F.size("gs") > 1).select("gs", F.explode("gs").alias("g")).join(wide, "g")
    of_wide = many.select("gs", F.explode("gs").alias("g")).join(
        few.select(F.col("gs").alias("gs2"), "n", "ws", F.explode("gs").alias("g")), "g")
    # A pair that meets in several groups is taken in the first of them, so it is summed before the shuffle.
    pairs = in_more.unionByName(of_wide).where(F.array_intersect("gs", "gs2")[0] == F.col("g"))

    sizes = parts.unionByName(in_one).unionByName(pairs.select("gs", F.col("n").alias("u"), F.col("ws").alias("us")))
    sizes = sizes.groupBy("gs").agg(F.sum("u").alias("u"), F.sum("us").alias("us"))
    return per_v.join(sizes, "gs").select("v", "u", "us", "w")


def cluster_sanctions_ratio(g: Graph) -> DataFrame:
    """Share of distinct co-owned peers (same direct owner) that are sanctioned."""
    sanctioned = g.sanctioned_by.select(F.col("src_id").alias("v")).distinct().withColumn("w", F.lit(1))
    mem = g.owned_by.select(F.col("src_id").alias("v"), F.col("dst_id").alias("g"))
    u = union_sizes(mem, sanctioned)
    peers = F.col("u") - 1
    r = u.where(peers > 0).select(
        F.col("v").alias("mmsi"), ((F.col("us") - F.col("w")) / peers).alias("cluster_sanctions_ratio")
    )
    return _per_vessel(g, r, "cluster_sanctions_ratio", 0.0)


def shared_manager_risk(g: Graph, distance: DataFrame) -> DataFrame:
    """Min sanctions distance among same-manager peers (99 if none / unknown).

    Exact without forming pairs: per manager keep the smallest (distance, mmsi)
    and the smallest distance among the other members; a vessel takes the
    first unless it is that member itself.
    """
    mgd = g.managed_by.select(F.col("src_id").alias("mmsi"), F.col("dst_id").alias("m")).distinct()
    d = mgd.join(distance.select("mmsi", "sanctions_distance"), "mmsi", "left").select(
        "m", "mmsi", F.coalesce("sanctions_distance", F.lit(C.MAX_HOPS)).alias("d")
    )
    best = d.groupBy("m").agg(F.min(F.struct("d", "mmsi")).alias("b1"))
    second = (
        d.join(best, "m").where(F.col("mmsi") != F.col("b1.mmsi"))
        .groupBy("m").agg(F.min("d").alias("d2"))
    )
    per_m = best.join(second, "m", "left")
    r = (
        mgd.join(per_m, "m")
        .select("mmsi", F.when(F.col("mmsi") != F.col("b1.mmsi"), F.col("b1.d")).otherwise(F.col("d2")).alias("peer_d"))
        .groupBy("mmsi").agg(F.min("peer_d").alias("shared_manager_risk"))
    )
    return _per_vessel(g, r, "shared_manager_risk", C.MAX_HOPS).withColumn(
        "shared_manager_risk", F.col("shared_manager_risk").cast("long")
    )


def shared_address_centrality(g: Graph) -> DataFrame:
    """Distinct vessels sharing a registered address through an owner or manager."""
    va = (
        vessel_companies(g)
        .join(g.registered_at.select(F.col("src_id").alias("company"), F.col("dst_id").alias("address")), "company")
        .select(F.col("mmsi").alias("v"), F.col("address").alias("g")).distinct()
    )
    u = union_sizes(va)
    r = u.select(F.col("v").alias("mmsi"), (F.col("u") - 1).alias("shared_address_centrality"))
    return _per_vessel(g, r, "shared_address_centrality", 0)


def sanctions_list_count(vessel_meta: DataFrame, sanctions_entities: DataFrame) -> DataFrame:
    """distinct ';'-separated programs reaching a vessel by mmsi or through its imo."""
    se = sanctions_entities
    by_mmsi = se.where(F.col("mmsi").isNotNull() & (F.col("mmsi") != "")).select(
        "mmsi", F.explode(F.split("list_source", ";")).alias("program")
    )
    vm = vessel_meta.where(
        F.col("imo").isNotNull() & (F.col("imo") != "") & F.col("mmsi").isNotNull() & (F.col("mmsi") != "")
    ).select("mmsi", F.col("imo").alias("vm_imo"))
    by_imo = vm.join(se.select("imo", "list_source"), vm.vm_imo == se.imo).select(
        "mmsi", F.explode(F.split("list_source", ";")).alias("program")
    )
    return (
        by_mmsi.unionByName(by_imo)
        .where(F.col("program").isNotNull() & (F.col("program") != ""))
        .groupBy("mmsi").agg(F.countDistinct("program").alias("sanctions_list_count"))
    )


def ownership_parts(g: Graph, sanctions_entities: DataFrame) -> list[DataFrame]:
    """The ownership family's columns in frames of their own; the distance is worked out once."""
    dist = cut_lineage(direct_sanctions_fallback(sanctions_distance(g), sanctions_entities))
    return [dist, cluster_sanctions_ratio(g), shared_manager_risk(g, dist), shared_address_centrality(g)]


def identity_parts(g: Graph) -> list[DataFrame]:
    """The identity family's columns (G4, G5, G6) in frames of their own."""
    return [name_owner_changes(g), ownership_depth(g), high_risk_flag_ratio(g)]


def ownership_features(g: Graph, sanctions_entities: DataFrame, sts_degree: DataFrame | None = None) -> DataFrame:
    """Ownership family: distance (with fallback), cluster ratio, manager risk, address centrality, STS degree."""
    dist = direct_sanctions_fallback(sanctions_distance(g), sanctions_entities)
    out = (
        dist.join(cluster_sanctions_ratio(g), "mmsi", "left")
        .join(shared_manager_risk(g, dist), "mmsi", "left")
        .join(shared_address_centrality(g), "mmsi", "left")
    )
    if sts_degree is not None:
        out = out.join(sts_degree, "mmsi", "left")
    else:
        out = out.withColumn("sts_hub_degree", F.lit(None).cast("long"))
    return out.withColumn("sts_hub_degree", F.coalesce("sts_hub_degree", F.lit(0)).cast("long"))


def identity_graph_features(g: Graph) -> DataFrame:
    """Identity family from the graph: G4, G5, G6."""
    return (
        name_owner_changes(g).join(ownership_depth(g), "mmsi").join(high_risk_flag_ratio(g), "mmsi")
    )

