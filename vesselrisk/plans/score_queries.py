"""Feature-matrix, scoring and propagation queries (F14, M2-M10, P3, G13) with oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import tracks
from ..oracle import with_views
from ..session import cut_lineage
from ..sources.fixtures import Fixtures
from . import anomaly, propagation, scoring
from .baseline import BEHAVIOUR_DEFAULTS, behaviour_baseline
from .features import DEFAULTS, build_feature_matrix
from .fusion_queries import detection_window
from .registry import ORACLE, finish, register
from .track_queries import STS_CONTACTS_SQL, WIN_SQL, cell_sql

REF_DATE = dt.date(2024, 1, 31)


def feature_matrix(spark, base, skip_eo: bool = False, columns: list[str] | None = None):
    fx = Fixtures(spark, base)
    det = detection_window(fx.detections)
    return build_feature_matrix(
        fx.ais_positions, fx.vessel_meta, fx.sanctions_entities, fx.owned_by, fx.managed_by,
        fx.controlled_by, fx.registered_in, fx.registered_at, fx.trade_flow, fx.equasis_vessel_ref,
        sar=det, eo=det, skip_eo=skip_eo, columns=columns,
    )


def _family(name: str, alias: str) -> tuple[str, str]:
    return alias, ORACLE[name]


_FAMILIES = [
    ("gap_features", "f_gap"), ("position_jumps", "f_jump"), ("sts_candidates", "f_sts"),
    ("loitering", "f_loit"), ("port_call_ratio", "f_port"), ("chokepoint_gaps", "f_choke"),
    ("pre_gap_regularity", "f_reg"), ("imo_mismatch", "f_imo"), ("identity_changes", "f_ident"),
    ("ownership_depth", "f_depth"), ("high_risk_flag_ratio", "f_hr"), ("sanctions_fallback", "f_dist"),
    ("cluster_ratio", "f_cluster"), ("manager_risk", "f_mgr"), ("address_centrality", "f_addr"),
    ("trade_mismatch", "f_trade"), ("sar_unmatched", "f_sar"), ("eo_fusion", "f_eo"),
    ("sanctions_list_count", "f_slc"), ("sts_hub_degree", "f_deg"),
]

_SOURCE = {
    "ais_gap_count_30d": "f_gap", "ais_gap_max_hours": "f_gap", "position_jump_count": "f_jump",
    "sts_candidate_count": "f_sts", "port_call_ratio": "f_port", "loitering_hours_30d": "f_loit",
    "chokepoint_exit_gap_count": "f_choke", "ais_pre_gap_regularity": "f_reg",
    "imo_type_mismatch": "f_imo", "imo_scrapped_flag": "f_imo", "imo_under_construction_flag": "f_imo",
    "flag_changes_2y": "f_ident", "name_changes_2y": "f_ident", "owner_changes_2y": "f_ident",
    "high_risk_flag_ratio": "f_hr", "ownership_depth": "f_depth", "sanctions_distance": "f_dist",
    "cluster_sanctions_ratio": "f_cluster", "shared_manager_risk": "f_mgr",
    "shared_address_centrality": "f_addr", "sts_hub_degree": "f_deg", "route_cargo_mismatch": "f_trade",
    "declared_vs_estimated_cargo_value": "f_trade", "unmatched_sar_detections_30d": "f_sar",
    "eo_dark_count_30d": "f_eo", "eo_ais_mismatch_ratio": "f_eo", "sanctions_list_count": "f_slc",
}


def _lit_sql(v) -> str:
    if isinstance(v, bool):
        return "false" if not v else "true"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return f"CAST({v} AS BIGINT)"


def _matrix_sql(rounded: bool = True) -> str:
    ctes = [_family(n, a) for n, a in _FAMILIES]
    ctes.append(("win_m", with_views("ais_positions", extra=[("win", WIN_SQL)]) + "SELECT DISTINCT mmsi FROM win"))
    ctes.append(("allm", "SELECT mmsi FROM win_m UNION SELECT mmsi FROM vessel_meta"))
    ctes.append(("listed", "SELECT DISTINCT mmsi FROM sanctions_entities WHERE mmsi IS NOT NULL AND mmsi <> ''"))
    cols = []
    for c, v in DEFAULTS.items():
        src = _SOURCE[c]
        if c == "sanctions_distance":
            expr = f"COALESCE({src}.{c}, CASE WHEN m.mmsi IN (SELECT mmsi FROM listed) THEN 0 ELSE 99 END)"
        else:
            expr = f"COALESCE({src}.{c}, {_lit_sql(v)})"
        if isinstance(v, bool):
            cols.append(f"{expr} AS {c}")
        elif isinstance(v, float):
            cols.append(f"round(CAST({expr} AS DOUBLE), 6) AS {c}" if rounded else f"CAST({expr} AS DOUBLE) AS {c}")
        else:
            cols.append(f"CAST({expr} AS BIGINT) AS {c}")
    joins = " ".join(f"LEFT JOIN {a} ON {a}.mmsi = m.mmsi" for _, a in _FAMILIES)
    head = with_views("vessel_meta", "sanctions_entities", extra=ctes)
    return head + f"SELECT m.mmsi, {', '.join(cols)} FROM allm m {joins}"


@register("feature_matrix")
def q_feature_matrix(spark, base):
    return finish(feature_matrix(spark, base))


ORACLE["feature_matrix"] = _matrix_sql()


def _context(spark, base, columns: list[str] | None = None):
    fx = Fixtures(spark, base)
    fm = cut_lineage(feature_matrix(spark, base, columns=columns))
    return scoring.scoring_context(fm, fx.vessel_meta, fx.ais_positions)


CTX_SQL_CTES = [
    ("fm", _matrix_sql(rounded=False)),
    ("lp", """SELECT mmsi, lat AS last_lat, lon AS last_lon, timestamp AS last_seen FROM (
        SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY timestamp DESC) AS rn FROM ais_positions) WHERE rn = 1"""),
    ("am", """SELECT mmsi, min(ship_type) AS ais_ship_type FROM (
        SELECT mmsi, ship_type, count(*) AS n, max(count(*)) OVER (PARTITION BY mmsi) AS mx FROM ais_positions
        WHERE ship_type IS NOT NULL AND ship_type > 0 GROUP BY mmsi, ship_type) WHERE n = mx GROUP BY mmsi"""),
    ("ctx", """SELECT fm.*, COALESCE(vm.imo, '') AS imo, COALESCE(vm.name, fm.mmsi) AS vessel_name,
        CAST(COALESCE(vm.ship_type, am.ais_ship_type, 0) AS BIGINT) AS ship_type,
        COALESCE(NULLIF(vm.flag, ''), '') AS flag, lp.last_lat, lp.last_lon, lp.last_seen
        FROM fm LEFT JOIN vessel_meta vm ON vm.mmsi = fm.mmsi LEFT JOIN lp ON lp.mmsi = fm.mmsi
        LEFT JOIN am ON am.mmsi = fm.mmsi"""),
]


def ctx_sql(body: str, *extra) -> str:
    return with_views("ais_positions", "vessel_meta", extra=[*CTX_SQL_CTES, *extra]) + body


@register(
    "context_latest",
    ctx_sql("""SELECT mmsi, imo, vessel_name, ship_type, flag, round(last_lat, 6) AS last_lat,
       round(last_lon, 6) AS last_lon, epoch_us(last_seen) AS last_seen_us FROM ctx"""),
)
def q_context_latest(spark, base):
    c = _context(spark, base, columns=[])
    return finish(c.select("mmsi", "imo", "vessel_name", "ship_type", "flag", "last_lat", "last_lon",
                           F.unix_micros("last_seen").alias("last_seen_us")))


def _clip(x: str) -> str:
    return f"least(greatest({x}, 0.0), 1.0)"


GRAPH_RISK_SQL = (
    f"0.45 * (CASE WHEN sanctions_distance >= 99 THEN 0.0 ELSE {_clip('1.0 - sanctions_distance / 5.0')} END)"
    f" + 0.25 * {_clip('cluster_sanctions_ratio')}"
    f" + 0.10 * (CASE WHEN shared_manager_risk >= 99 THEN 0.0 ELSE {_clip('1.0 - shared_manager_risk / 5.0')} END)"
    f" + 0.10 * {_clip('sts_hub_degree / 10.0')} + 0.10 * {_clip('COALESCE(sanctions_list_count, 0) / 5.0')}"
)
IDENTITY_SQL = (
    f"0.40 * {_clip('name_changes_2y / 5.0')} + 0.30 * {_clip('owner_changes_2y / 5.0')}"
    f" + 0.20 * {_clip('high_risk_flag_ratio')} + 0.10 * {_clip('ownership_depth / 6.0')}"
)


@register("graph_risk", with_views(extra=[("fm", _matrix_sql(rounded=False))])
          + f"SELECT mmsi, round({GRAPH_RISK_SQL}, 6) AS graph_risk_score FROM fm")
def q_graph_risk(spark, base):
    # Scores over the published (6-dp) matrix, of the features that they use.
    used = ["sanctions_distance", "cluster_sanctions_ratio", "shared_manager_risk", "sts_hub_degree", "sanctions_list_count"]
    fm = finish(feature_matrix(spark, base, columns=used))
    return finish(fm.select("mmsi", scoring.graph_risk_score(fm).alias("graph_risk_score")))


@register("identity_score", with_views(extra=[("fm", _matrix_sql(rounded=False))])
          + f"SELECT mmsi, round({IDENTITY_SQL}, 6) AS identity_score FROM fm")
def q_identity_score(spark, base):
    used = ["name_changes_2y", "owner_changes_2y", "high_risk_flag_ratio", "ownership_depth"]
    fm = finish(feature_matrix(spark, base, columns=used))
    return finish(fm.select("mmsi", scoring.identity_score().alias("identity_score")))


def _top_sql() -> str:
    from .scoring import FEATURE_VALUE_COLUMNS as cols
    parts = [f"SELECT mmsi, {i} AS idx, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM fm" for i, c in enumerate(cols)]
    return (
        with_views(extra=[("fm", _matrix_sql(rounded=False)), ("items", " UNION ALL ".join(parts)),
                          ("ranked", """SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY abs(value) DESC, idx) AS rk
                                        FROM items WHERE value IS NOT NULL""")])
        + "SELECT mmsi, CAST(rk AS BIGINT) AS rank, feature, round(value, 6) AS value, round(round(abs(value), 3), 6) AS contribution "
          "FROM ranked WHERE rk <= 5"
    )


@register("top_signals", _top_sql())
def q_top_signals(spark, base):
    return finish(scoring.top_signals_long(finish(feature_matrix(spark, base))))


def _geo_sql() -> str:
    rows = []
    for order, (name, start, end, boxes, w) in enumerate(scoring.DEFAULT_GEO_EVENTS):
        for a, b, c, d in boxes:
            rows.append(f"({order}, DATE '{start}', DATE '{end}', {a}, {b}, {c}, {d}, {w})")
    ev = ("SELECT * FROM (VALUES " + ", ".join(rows)
          + ") t(event_order, active_from, active_to, lat_min, lat_max, lon_min, lon_max, down_weight)")
    return ctx_sql(
        """SELECT c.mmsi, round(COALESCE(h.w, 1.0), 6) AS geo_weight FROM ctx c LEFT JOIN (
             SELECT mmsi, arg_min(down_weight, event_order) AS w FROM ctx JOIN ev
             ON last_lat BETWEEN lat_min AND lat_max AND last_lon BETWEEN lon_min AND lon_max
             WHERE DATE '2024-01-31' BETWEEN active_from AND active_to GROUP BY mmsi) h ON h.mmsi = c.mmsi""",
        ("ev", ev),
    )


@register("geo_filter", _geo_sql())
def q_geo_filter(spark, base):
    c = _context(spark, base, columns=[])
    return finish(scoring.geo_factor(c, scoring.geo_events_frame(spark), REF_DATE))


PROP_CTES = [
    ("cb", f"""SELECT mmsi, {cell_sql()} AS cell, epoch_us(timestamp) // 1800000000 AS bucket FROM ais_positions
               WHERE lat IS NOT NULL AND lon IS NOT NULL AND mmsi IS NOT NULL"""),
    ("sts", STS_CONTACTS_SQL),
    ("seeds", """SELECT mmsi, max(reviewed_at) AS confirmed_at FROM vessel_reviews
                 WHERE review_tier = 'confirmed' AND reviewed_at <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY mmsi"""),
    ("own", """SELECT b.src_id AS mmsi, min(a.src_id) AS source_mmsi, 1 AS prio FROM owned_by a JOIN owned_by b
               ON a.dst_id = b.dst_id AND a.src_id <> b.src_id WHERE a.src_id IN (SELECT mmsi FROM seeds) GROUP BY b.src_id"""),
    ("mgr", """SELECT b.src_id AS mmsi, min(a.src_id) AS source_mmsi, 2 AS prio FROM managed_by a JOIN managed_by b
               ON a.dst_id = b.dst_id AND a.src_id <> b.src_id WHERE a.src_id IN (SELECT mmsi FROM seeds) GROUP BY b.src_id"""),
    ("stsp", """SELECT mmsi, min(source_mmsi) AS source_mmsi, 3 AS prio FROM (
                  SELECT dst_id AS mmsi, src_id AS source_mmsi FROM sts WHERE src_id IN (SELECT mmsi FROM seeds)
                  UNION ALL SELECT src_id, dst_id FROM sts WHERE dst_id IN (SELECT mmsi FROM seeds)) GROUP BY mmsi"""),
    ("cand", """SELECT mmsi, mmsi AS source_mmsi, 0 AS prio FROM seeds UNION ALL SELECT * FROM own
                UNION ALL SELECT * FROM mgr UNION ALL SELECT * FROM stsp"""),
    ("best", """SELECT mmsi, source_mmsi, prio FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY prio, source_mmsi) AS rn
                FROM cand) WHERE rn = 1"""),
    ("prop", """SELECT b.mmsi, b.source_mmsi, CAST(CASE WHEN prio = 0 THEN 0 ELSE 1 END AS BIGINT) AS hop,
                CASE prio WHEN 0 THEN 'confirmed_direct' WHEN 1 THEN 'shared_owner' WHEN 2 THEN 'shared_manager' ELSE 'sts_contact' END AS evidence_type,
                CASE prio WHEN 0 THEN 1.0 WHEN 1 THEN 0.65 WHEN 2 THEN 0.60 ELSE 0.50 END AS propagated_confidence,
                strftime(s.confirmed_at, '%Y-%m-%d %H:%M:%S.%f') AS confirmed_at
                FROM best b LEFT JOIN seeds s ON s.mmsi = b.source_mmsi"""),
]

PROP_SQL_HEAD = with_views("ais_positions", "vessel_reviews", "owned_by", "managed_by", extra=PROP_CTES)


def _propagated(spark, base):
    fx = Fixtures(spark, base)
    contacts = tracks.sts_contacts(fx.ais_positions, marked=propagation.confirmed_seeds(fx.vessel_reviews), least=True)
    return propagation.propagate_labels(fx.vessel_reviews, fx.owned_by, fx.managed_by, contacts)


@register("label_propagation", PROP_SQL_HEAD + """SELECT mmsi, source_mmsi, hop, evidence_type,
    round(propagated_confidence, 6) AS propagated_confidence, confirmed_at FROM prop""")
def q_label_propagation(spark, base):
    return finish(_propagated(spark, base))


@register("propagation_floor", PROP_SQL_HEAD + """SELECT mmsi, round(max(propagated_confidence), 6) AS floor,
    arg_max(evidence_type, propagated_confidence) AS floor_evidence FROM prop WHERE propagated_confidence > 0 GROUP BY mmsi""")
def q_propagation_floor(spark, base):
    return finish(scoring.propagation_floor(_propagated(spark, base)))


@register(
    "candidate_best",
    with_views("ranked_items")
    + """SELECT mmsi, imo, vessel_type, region, round(confidence, 6) AS confidence FROM (
  SELECT mmsi, '' AS imo, vessel_type, region, confidence,
         row_number() OVER (PARTITION BY mmsi ORDER BY confidence DESC, vessel_type DESC, region DESC) AS rn
  FROM ranked_items) WHERE rn = 1""",
)
def q_candidate_best(spark, base):
    r = Fixtures(spark, base).ranked_items.select("mmsi", F.lit("").alias("imo"), "vessel_type", "region", "confidence")
    return finish(scoring.best_candidates(r, ("mmsi", "imo"), "confidence"))


def watchlist(spark, base, n_trees: int = 200):
    """M9: the ranked watchlist (flagship). Feature matrix is checkpointed once and reused."""
    fx = Fixtures(spark, base)
    fm = cut_lineage(feature_matrix(spark, base))
    ctx = scoring.scoring_context(fm, fx.vessel_meta, fx.ais_positions)
    an = anomaly.anomaly_scores(fm, behaviour_baseline(fm, fx.vessel_meta), n_trees=n_trees)
    geo = scoring.geo_factor(ctx, scoring.geo_events_frame(spark), REF_DATE)
    floor = scoring.propagation_floor(_propagated(spark, base))
    scored = scoring.composite_scores(ctx, an, geo=geo, floor=floor)
    return scoring.watchlist_order(scored.withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz")))


@register("anomaly_scores")
def q_anomaly_scores(spark, base):
    fm = cut_lineage(feature_matrix(spark, base))
    return finish(anomaly.anomaly_scores(fm, behaviour_baseline(fm, Fixtures(spark, base).vessel_meta)))


@register("behaviour_baseline")
def q_behaviour_baseline(spark, base):
    """M1 over the whole fleet."""
    return finish(behaviour_baseline(feature_matrix(spark, base, columns=list(BEHAVIOUR_DEFAULTS)), Fixtures(spark, base).vessel_meta))


@register("watchlist")
def q_watchlist(spark, base):
    return finish(watchlist(spark, base))

