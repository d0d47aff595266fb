"""Graph, identity, trade and sanctions queries (F11-F13, G3-G11) with oracle SQL."""

from __future__ import annotations

from .. import config as C
from ..operators import graph as G
from ..operators import identity as I
from ..oracle import with_views
from ..sources.fixtures import Fixtures
from .registry import finish, register

GRAPH_VIEWS = ("vessel_meta", "sanctions_entities", "owned_by", "managed_by", "controlled_by",
               "registered_in", "registered_at")

_COMPANY_TYPES_SQL = ", ".join(f"'{t}'" for t in C.COMPANY_TYPES)

GRAPH_CTES = [
    ("vessels", "SELECT DISTINCT mmsi FROM vessel_meta WHERE mmsi IS NOT NULL"),
    ("imo_index", "SELECT imo, min(mmsi) AS imo_mmsi FROM vessel_meta WHERE imo IS NOT NULL AND imo <> '' GROUP BY imo"),
    ("sb", f"""SELECT DISTINCT src_id, dst_id FROM (
        SELECT CASE WHEN COALESCE(se.mmsi, '') <> '' THEN se.mmsi ELSE ii.imo_mmsi END AS src_id, se.list_source AS dst_id
        FROM sanctions_entities se LEFT JOIN imo_index ii ON COALESCE(se.imo, '') = ii.imo
        WHERE (se.type = 'Vessel' OR (se.mmsi IS NOT NULL AND se.mmsi <> '')) AND (se.mmsi IS NOT NULL OR se.imo IS NOT NULL)
        UNION ALL
        SELECT entity_id, list_source FROM sanctions_entities WHERE type IN ({_COMPANY_TYPES_SQL})
      ) WHERE src_id IS NOT NULL AND src_id <> ''"""),
    ("sanc", "SELECT DISTINCT src_id AS id FROM sb"),
    ("vc", "SELECT src_id AS mmsi, dst_id AS company FROM owned_by UNION SELECT src_id, dst_id FROM managed_by"),
    ("one", "SELECT DISTINCT mmsi FROM vc WHERE company IN (SELECT id FROM sanc)"),
    ("sp", "SELECT src_id AS c FROM controlled_by WHERE dst_id IN (SELECT id FROM sanc)"),
    ("two", "SELECT DISTINCT mmsi FROM vc WHERE company IN (SELECT c FROM sp)"),
    ("sgp", "SELECT src_id AS c FROM controlled_by WHERE dst_id IN (SELECT c FROM sp)"),
    ("three", "SELECT DISTINCT mmsi FROM vc WHERE company IN (SELECT c FROM sgp)"),
    ("dist_raw", f"""SELECT v.mmsi, CASE WHEN v.mmsi IN (SELECT id FROM sanc) THEN 0
        WHEN v.mmsi IN (SELECT mmsi FROM one) THEN 1 WHEN v.mmsi IN (SELECT mmsi FROM two) THEN 2
        WHEN v.mmsi IN (SELECT mmsi FROM three) THEN 3 ELSE {C.MAX_HOPS} END AS sanctions_distance FROM vessels v"""),
    ("dist", f"""SELECT mmsi, CASE WHEN sanctions_distance = {C.MAX_HOPS} AND mmsi IN
        (SELECT mmsi FROM sanctions_entities WHERE mmsi IS NOT NULL AND mmsi <> '') THEN 0
        ELSE sanctions_distance END AS sanctions_distance FROM dist_raw"""),
]


def graph_sql(body: str, *extra: tuple[str, str], views: tuple[str, ...] = ()) -> str:
    return with_views(*GRAPH_VIEWS, *views, extra=[*GRAPH_CTES, *extra]) + body


def _graph(spark, base) -> G.Graph:
    fx = Fixtures(spark, base)
    return G.build_graph(fx.vessel_meta, fx.sanctions_entities, fx.owned_by, fx.managed_by,
                         fx.controlled_by, fx.registered_in, fx.registered_at)


@register("graph_edges", graph_sql("SELECT src_id, dst_id FROM sb"))
def q_graph_edges(spark, base):
    return _graph(spark, base).sanctioned_by


@register(
    "identity_changes",
    graph_sql("""SELECT v.mmsi, CAST(0 AS BIGINT) AS flag_changes_2y, CAST(0 AS BIGINT) AS name_changes_2y,
       CAST(COALESCE(o.n, 0) AS BIGINT) AS owner_changes_2y
FROM vessels v LEFT JOIN (SELECT src_id, count(*) AS n FROM owned_by GROUP BY src_id) o ON o.src_id = v.mmsi"""),
)
def q_identity_changes(spark, base):
    return finish(G.name_owner_changes(_graph(spark, base)))


@register(
    "ownership_depth",
    graph_sql(
        """SELECT v.mmsi, CAST(COALESCE(1 + d.h, 0) AS BIGINT) AS ownership_depth
FROM vessels v LEFT JOIN (SELECT mmsi, max(h) AS h FROM (
  SELECT mmsi, 0 AS h FROM f0 UNION ALL SELECT mmsi, 1 FROM f1 UNION ALL SELECT mmsi, 2 FROM f2
  UNION ALL SELECT mmsi, 3 FROM f3 UNION ALL SELECT mmsi, 4 FROM f4 UNION ALL SELECT mmsi, 5 FROM f5) GROUP BY mmsi) d
ON d.mmsi = v.mmsi""",
        ("cbe", "SELECT DISTINCT src_id AS c, dst_id AS p FROM controlled_by"),
        ("f0", "SELECT DISTINCT src_id AS mmsi, dst_id AS c FROM owned_by"),
        *[(f"f{i}", f"SELECT DISTINCT f.mmsi, e.p AS c FROM f{i - 1} f JOIN cbe e ON e.c = f.c") for i in range(1, 6)],
    ),
)
def q_ownership_depth(spark, base):
    return finish(G.ownership_depth(_graph(spark, base)))


_HR_SQL = ", ".join(f"'{f}'" for f in C.HIGH_RISK_FLAGS)


@register(
    "high_risk_flag_ratio",
    graph_sql(
        f"""SELECT v.mmsi, round(COALESCE(r.ratio, 0.0), 6) AS high_risk_flag_ratio FROM vessels v LEFT JOIN (
  SELECT mmsi, count(*) FILTER (WHERE country IN ({_HR_SQL})) / CAST(count(*) AS DOUBLE) AS ratio FROM (
    SELECT DISTINCT o.src_id AS mmsi, r.dst_id AS country FROM owned_by o JOIN registered_in r ON r.src_id = o.dst_id)
  GROUP BY mmsi) r ON r.mmsi = v.mmsi"""
    ),
)
def q_high_risk_flag_ratio(spark, base):
    return finish(G.high_risk_flag_ratio(_graph(spark, base)))


@register("sanctions_distance", graph_sql("SELECT mmsi, CAST(sanctions_distance AS BIGINT) AS sanctions_distance FROM dist_raw"))
def q_sanctions_distance(spark, base):
    return finish(G.sanctions_distance(_graph(spark, base)))


@register("sanctions_fallback", graph_sql("SELECT mmsi, CAST(sanctions_distance AS BIGINT) AS sanctions_distance FROM dist"))
def q_sanctions_fallback(spark, base):
    fx = Fixtures(spark, base)
    return finish(G.direct_sanctions_fallback(G.sanctions_distance(_graph(spark, base)), fx.sanctions_entities))


@register(
    "cluster_ratio",
    graph_sql(
        """SELECT v.mmsi, round(COALESCE(r.ratio, 0.0), 6) AS cluster_sanctions_ratio FROM vessels v LEFT JOIN (
  SELECT vessel, count(*) FILTER (WHERE peer IN (SELECT id FROM sanc)) / CAST(count(*) AS DOUBLE) AS ratio FROM (
    SELECT DISTINCT a.src_id AS vessel, b.src_id AS peer FROM owned_by a JOIN owned_by b ON a.dst_id = b.dst_id
    WHERE a.src_id <> b.src_id) GROUP BY vessel) r ON r.vessel = v.mmsi"""
    ),
)
def q_cluster_ratio(spark, base):
    return finish(G.cluster_sanctions_ratio(_graph(spark, base)))


@register(
    "manager_risk",
    graph_sql(
        f"""SELECT v.mmsi, CAST(COALESCE(r.d, {C.MAX_HOPS}) AS BIGINT) AS shared_manager_risk FROM vessels v LEFT JOIN (
  SELECT p.vessel, min(COALESCE(dist.sanctions_distance, {C.MAX_HOPS})) AS d FROM (
    SELECT DISTINCT a.src_id AS vessel, b.src_id AS peer FROM managed_by a JOIN managed_by b ON a.dst_id = b.dst_id
    WHERE a.src_id <> b.src_id) p LEFT JOIN dist ON dist.mmsi = p.peer GROUP BY p.vessel) r ON r.vessel = v.mmsi"""
    ),
)
def q_manager_risk(spark, base):
    fx = Fixtures(spark, base)
    g = _graph(spark, base)
    dist = G.direct_sanctions_fallback(G.sanctions_distance(g), fx.sanctions_entities)
    return finish(G.shared_manager_risk(g, dist))


@register(
    "address_centrality",
    graph_sql(
        """SELECT v.mmsi, CAST(COALESCE(r.n, 0) AS BIGINT) AS shared_address_centrality FROM vessels v LEFT JOIN (
  SELECT a.mmsi, count(DISTINCT b.mmsi) AS n FROM va a JOIN va b ON a.address = b.address AND a.mmsi <> b.mmsi
  GROUP BY a.mmsi) r ON r.mmsi = v.mmsi""",
        ("va", "SELECT DISTINCT vc.mmsi, ra.dst_id AS address FROM vc JOIN registered_at ra ON ra.src_id = vc.company"),
    ),
)
def q_address_centrality(spark, base):
    return finish(G.shared_address_centrality(_graph(spark, base)))


CAT_SQL = ("CASE WHEN {x} IS NULL THEN 0 WHEN {x} = 30 THEN 1 WHEN {x} BETWEEN 31 AND 57 THEN 2 "
           "WHEN {x} BETWEEN 60 AND 69 THEN 3 WHEN {x} BETWEEN 70 AND 79 THEN 4 WHEN {x} BETWEEN 80 AND 89 THEN 5 ELSE 0 END")


@register(
    "imo_mismatch",
    with_views("vessel_meta", "equasis_vessel_ref", extra=[
        ("meta", "SELECT mmsi, COALESCE(imo, '') AS imo, ship_type FROM vessel_meta WHERE mmsi IS NOT NULL"),
        ("res", f"""SELECT m.mmsi,
            ({CAT_SQL.format(x='m.ship_type')}) <> 0 AND ({CAT_SQL.format(x='r.vessel_type')}) <> 0
              AND ({CAT_SQL.format(x='m.ship_type')}) <> ({CAT_SQL.format(x='r.vessel_type')}) AS imo_type_mismatch,
            COALESCE(r.scrapped, false) AS imo_scrapped_flag,
            COALESCE(r.build_year > 2024, false) AS imo_under_construction_flag
          FROM meta m LEFT JOIN equasis_vessel_ref r ON r.imo = m.imo WHERE m.imo <> ''"""),
    ])
    + """SELECT m.mmsi, COALESCE(r.imo_type_mismatch, false) AS imo_type_mismatch,
       COALESCE(r.imo_scrapped_flag, false) AS imo_scrapped_flag,
       COALESCE(r.imo_under_construction_flag, false) AS imo_under_construction_flag
FROM meta m LEFT JOIN res r ON r.mmsi = m.mmsi""",
)
def q_imo_mismatch(spark, base):
    fx = Fixtures(spark, base)
    return I.imo_mismatch(fx.vessel_meta, fx.equasis_vessel_ref)


_SANC_EXP_SQL = ", ".join(f"'{f}'" for f in C.SANCTIONED_EXPORTERS)


@register(
    "trade_mismatch",
    with_views("vessel_meta", "trade_flow", extra=[
        ("vm", "SELECT mmsi, COALESCE(flag, '') AS flag, COALESCE(ship_type, 0) AS ship_type FROM vessel_meta WHERE mmsi IS NOT NULL"),
        ("tr", "SELECT partner, sum(trade_value_usd) AS total FROM trade_flow WHERE reporter = '702' AND hs_code = '2709' GROUP BY partner"),
        ("fc", "SELECT flag, count(*) AS n FROM vm GROUP BY flag"),
        ("j", f"""SELECT vm.mmsi, vm.ship_type BETWEEN 80 AND 89 AND vm.flag IN ({_SANC_EXP_SQL}) AS hit,
                  COALESCE(tr.total, 0.0) AS tv, fc.n FROM vm LEFT JOIN tr ON tr.partner = vm.flag LEFT JOIN fc ON fc.flag = vm.flag"""),
    ])
    + """SELECT mmsi, CASE WHEN hit THEN (CASE WHEN tv > 0 THEN 0.0 ELSE 1.0 END) ELSE 0.0 END AS route_cargo_mismatch,
       round(CASE WHEN hit AND tv > 0 THEN tv / n ELSE 0.0 END, 6) AS declared_vs_estimated_cargo_value FROM j""",
)
def q_trade_mismatch(spark, base):
    fx = Fixtures(spark, base)
    return finish(I.trade_mismatch(fx.vessel_meta, fx.trade_flow))


@register(
    "sanctions_list_count",
    with_views("vessel_meta", "sanctions_entities", extra=[
        ("vp", """SELECT se.mmsi, UNNEST(string_split(se.list_source, ';')) AS program FROM sanctions_entities se
                  WHERE se.mmsi IS NOT NULL AND se.mmsi <> ''
                  UNION
                  SELECT vm.mmsi, UNNEST(string_split(se.list_source, ';')) AS program FROM vessel_meta vm
                  JOIN sanctions_entities se ON se.imo = vm.imo
                  WHERE vm.imo IS NOT NULL AND vm.imo <> '' AND vm.mmsi IS NOT NULL AND vm.mmsi <> ''"""),
    ])
    + """SELECT mmsi, CAST(count(DISTINCT program) AS BIGINT) AS sanctions_list_count FROM vp
WHERE program IS NOT NULL AND program <> '' GROUP BY mmsi""",
)
def q_sanctions_list_count(spark, base):
    fx = Fixtures(spark, base)
    return finish(G.sanctions_list_count(fx.vessel_meta, fx.sanctions_entities))
