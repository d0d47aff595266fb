"""Causal queries (C1-C10) with oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..operators import graph as G
from ..operators import tracks
from ..sources.fixtures import Fixtures
from . import causal
from .graph_queries import GRAPH_CTES, GRAPH_VIEWS, _graph
from .registry import finish, register
from .track_queries import STS_BUCKETS_SQL, WIN_SQL
from ..oracle import with_views

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
LISTED_SQL = "SELECT mmsi FROM sanctions_entities WHERE mmsi IS NOT NULL AND mmsi <> ''"

VF_CTES = [
    *GRAPH_CTES,
    ("win", WIN_SQL),
    ("cb", STS_BUCKETS_SQL),
    ("stopped", "SELECT * FROM cb WHERE nav_status IN (0, 1, 3, 5)"),
    ("multi", "SELECT cell, bucket FROM stopped GROUP BY cell, bucket HAVING count(DISTINCT mmsi) >= 2"),
    ("sts", "SELECT s.mmsi, count(*) AS sts FROM stopped s JOIN multi m ON s.cell = m.cell AND s.bucket = m.bucket GROUP BY s.mmsi"),
    ("universe", "SELECT DISTINCT mmsi FROM win UNION SELECT mmsi FROM vessel_meta WHERE mmsi IS NOT NULL"),
    ("vf", f"""SELECT u.mmsi,
        CASE WHEN COALESCE(d.sanctions_distance, {C.MAX_HOPS}) = {C.MAX_HOPS} AND u.mmsi IN ({LISTED_SQL}) THEN 0
             ELSE COALESCE(d.sanctions_distance, {C.MAX_HOPS}) END AS sanctions_distance,
        COALESCE(s.sts, 0) AS sts_candidate_count, 0 AS flag_changes_2y
      FROM universe u LEFT JOIN dist d ON d.mmsi = u.mmsi LEFT JOIN sts s ON s.mmsi = u.mmsi"""),
]


def vf_sql(body: str, *extra: tuple[str, str]) -> str:
    return with_views(*GRAPH_VIEWS, "ais_positions", extra=[*VF_CTES, *extra]) + body


def vessel_features(spark, base):
    """The vessel_features columns these analyses read: distance (with fallback), STS count, flag changes."""
    fx = Fixtures(spark, base)
    win = tracks.position_window(fx.ais_positions)
    dist = G.sanctions_distance(_graph(spark, base))
    universe = win.select("mmsi").union(fx.vessel_meta.where(F.col("mmsi").isNotNull()).select("mmsi")).distinct()
    vf = universe.join(dist, "mmsi", "left").withColumn(
        "sanctions_distance", F.coalesce("sanctions_distance", F.lit(C.MAX_HOPS)).cast("long"))
    vf = G.direct_sanctions_fallback(vf, fx.sanctions_entities)
    sts = tracks.sts_candidates(win)
    return vf.join(sts, "mmsi", "left").select(
        "mmsi", "sanctions_distance", F.coalesce("sts_candidate_count", F.lit(0)).alias("sts_candidate_count"),
        F.lit(0).cast("long").alias("flag_changes_2y"))


def _did_windows_sql() -> str:
    dates = sorted({d for _k, _l, _s, _f, ds in C.SANCTION_REGIMES for d in ds})
    rows = []
    for d in dates:
        rows.append(f"('{d}|0', TIMESTAMP '{d} 00:00:00' - INTERVAL {C.DID_PRE_DAYS} DAY, TIMESTAMP '{d} 00:00:00')")
        rows.append(f"('{d}|1', TIMESTAMP '{d} 00:00:00', TIMESTAMP '{d} 00:00:00' + INTERVAL {C.DID_POST_DAYS} DAY)")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(wid, lo, hi)"


def _slots_sql() -> str:
    rows = [f"('{k}', '{lab}', '{d}', {post}, '{d}|{post}')"
            for k, lab, _s, _f, ds in C.SANCTION_REGIMES for d in ds for post in (0, 1)]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(regime, label, announcement_date, post, wid)"


CORRIDOR_SQL = "CASE " + " ".join(
    f"WHEN lon BETWEEN {lo0} AND {lo1} AND lat BETWEEN {la0} AND {la1} THEN {cid}"
    for cid, la0, la1, lo0, lo1 in C.CORRIDORS) + " ELSE 99 END"

DID_CTES = [
    ("wins", _did_windows_sql()),
    ("tagged", "SELECT w.wid, p.mmsi, p.timestamp FROM ais_positions p JOIN wins w ON p.timestamp BETWEEN w.lo AND w.hi"),
    ("lg", "SELECT *, lag(timestamp) OVER (PARTITION BY wid, mmsi ORDER BY timestamp) AS prev FROM tagged"),
    ("wgaps", """SELECT wid, mmsi, count(*) AS gaps FROM lg
        WHERE prev IS NOT NULL AND epoch_ms(timestamp) - epoch_ms(prev) > 21600000 GROUP BY wid, mmsi"""),
    ("grp", """SELECT DISTINCT mmsi, 1 AS treated FROM vf WHERE sanctions_distance <= 3 AND mmsi IN (SELECT mmsi FROM vessel_meta)
        UNION ALL SELECT DISTINCT mmsi, 0 FROM vf WHERE sanctions_distance >= 99"""),
    ("vt", "SELECT mmsi, max(COALESCE(ship_type, 0)) AS vessel_type FROM vessel_meta GROUP BY mmsi"),
    ("lastp", """SELECT mmsi, lat, lon FROM (SELECT mmsi, lat, lon, row_number() OVER
        (PARTITION BY mmsi ORDER BY timestamp DESC, lat DESC, lon DESC) AS rn FROM ais_positions) WHERE rn = 1"""),
    ("corr", f"SELECT mmsi, CASE WHEN lat IS NULL OR lon IS NULL THEN 0 ELSE {CORRIDOR_SQL} END AS corridor FROM lastp"),
    ("design", """SELECT g.mmsi, g.treated, COALESCE(vt.vessel_type, 0) AS vessel_type, COALESCE(c.corridor, 0) AS corridor
        FROM grp g LEFT JOIN vt ON vt.mmsi = g.mmsi LEFT JOIN corr c ON c.mmsi = g.mmsi"""),
    ("slots", _slots_sql()),
    ("drows", """SELECT d.*, s.regime, s.label, s.announcement_date, s.post, CAST(COALESCE(wg.gaps, 0) AS DOUBLE) AS y
        FROM design d CROSS JOIN slots s LEFT JOIN wgaps wg ON wg.wid = s.wid AND wg.mmsi = d.mmsi"""),
]


@register("did_cells", vf_sql("""SELECT regime, label, announcement_date, CAST(treated AS BIGINT) AS treated,
  CAST(post AS BIGINT) AS post, CAST(vessel_type AS BIGINT) AS vessel_type, CAST(corridor AS BIGINT) AS corridor,
  CAST(count(*) AS BIGINT) AS n_rows, round(sum(y), 6) AS sum_gaps, round(sum(y * y), 6) AS sum_gaps_sq
FROM drows GROUP BY ALL""", *DID_CTES))
def q_did_cells(spark, base):
    return finish(_cells(spark, base))


def _cells(spark, base):
    fx = Fixtures(spark, base)
    return causal.did_cells(fx.ais_positions, vessel_features(spark, base), fx.vessel_meta)


@register("did_estimate")
def q_did_estimate(spark, base):
    return finish(causal.did_estimates(_cells(spark, base)))


@register("regime_effects")
def q_regime_effects(spark, base):
    return finish(causal.regime_effects(causal.did_estimates(_cells(spark, base))))


@register("regime_effects_per_vessel")
def q_regime_effects_per_vessel(spark, base):
    fx = Fixtures(spark, base)
    eff = causal.regime_effects(causal.did_estimates(_cells(spark, base)))
    groups = causal.treatment_groups(vessel_features(spark, base), fx.vessel_meta)
    return finish(causal.effects_per_vessel(eff, groups))


UNKNOWN_CTES = [
    ("uw", f"""SELECT 'recent' AS wid, {AS_OF} - INTERVAL 30 DAY AS lo, {AS_OF} AS hi
        UNION ALL SELECT 'baseline', {AS_OF} - INTERVAL 90 DAY, {AS_OF} - INTERVAL 30 DAY"""),
    ("ut", "SELECT w.wid, p.mmsi, p.timestamp FROM ais_positions p JOIN uw w ON p.timestamp BETWEEN w.lo AND w.hi"),
    ("ul", "SELECT *, lag(timestamp) OVER (PARTITION BY wid, mmsi ORDER BY timestamp) AS prev FROM ut"),
    ("ug", """SELECT mmsi, count(*) FILTER (WHERE wid = 'recent') AS r, count(*) FILTER (WHERE wid = 'baseline') AS b
        FROM ul WHERE prev IS NOT NULL AND epoch_ms(timestamp) - epoch_ms(prev) > 21600000 GROUP BY mmsi"""),
    ("uj", """SELECT v.mmsi, CAST(v.sts_candidate_count AS DOUBLE) AS sts, CAST(v.flag_changes_2y AS DOUBLE) AS flags,
        CAST(COALESCE(g.r, 0) AS DOUBLE) AS r, CAST(COALESCE(g.b, 0) AS DOUBLE) AS b,
        round(CAST(COALESCE(g.r, 0) AS DOUBLE) / (CAST(COALESCE(g.b, 0) AS DOUBLE) + 1e-9), 4) AS gap_uplift
      FROM vf v LEFT JOIN ug g ON g.mmsi = v.mmsi WHERE v.sanctions_distance >= 99"""),
    ("us", """SELECT *, list_filter([
          CASE WHEN gap_uplift >= 1.5 THEN {'feature': 'ais_gap_count', 'u': gap_uplift} END,
          CASE WHEN sts >= 3 THEN {'feature': 'sts_candidate_count', 'u': round(sts, 4)} END,
          CASE WHEN flags >= 2 THEN {'feature': 'flag_changes_2y', 'u': round(flags, 4)} END], lambda x: x IS NOT NULL) AS sig
      FROM uj"""),
]


@register("unknown_unknowns", vf_sql("""SELECT mmsi,
  round(least(list_sum(list_transform(sig, lambda x: ln(greatest(x.u, 1.0)))) / len(sig) / ln(10.0), 1.0), 4) AS causal_score,
  CAST(len(sig) AS BIGINT) AS n_signals, array_to_string(list_transform(sig, lambda x: x.feature), ',') AS signals,
  r AS gaps_recent, b AS gaps_baseline, gap_uplift, sts AS sts_candidate_count, flags AS flag_changes_2y
FROM us WHERE len(sig) >= 1""", *UNKNOWN_CTES))
def q_unknown_unknowns(spark, base):
    fx = Fixtures(spark, base)
    return finish(causal.unknown_unknowns(fx.ais_positions, vessel_features(spark, base)), 4)


def _rewind(spark, base):
    fx = Fixtures(spark, base)
    return causal.rewind_windows(fx.ais_positions, causal.rewind_seeds(fx.vessel_reviews))


REWIND_CTES = [
    ("seeds", f"""SELECT mmsi, max(reviewed_at) AS confirmed_at FROM vessel_reviews
        WHERE review_tier = 'confirmed' AND reviewed_at <= {AS_OF} GROUP BY mmsi"""),
    ("rp", """SELECT p.mmsi, p.timestamp, COALESCE(p.sog, 0.0) AS sog, COALESCE(p.nav_status, 0) AS nav_status,
        CAST(floor((epoch_us(p.timestamp) - (epoch_us(s.confirmed_at) - 365 * 86400000000)) / 2592000000000) AS BIGINT) AS widx
      FROM ais_positions p JOIN seeds s ON s.mmsi = p.mmsi
      WHERE epoch_us(p.timestamp) >= epoch_us(s.confirmed_at) - 365 * 86400000000 AND p.timestamp < s.confirmed_at"""),
    ("rl", "SELECT *, lag(timestamp) OVER (PARTITION BY mmsi, widx ORDER BY timestamp) AS prev FROM rp"),
    ("rs", """SELECT mmsi, widx, count(*) AS n,
        count(*) FILTER (WHERE prev IS NOT NULL AND (epoch_us(timestamp) - epoch_us(prev)) // 60000000 > 360) AS g,
        count(*) FILTER (WHERE nav_status IN (0, 1, 3)) AS sts, count(*) FILTER (WHERE sog < 2.0) AS low
      FROM rl GROUP BY mmsi, widx"""),
    ("scaf", "SELECT mmsi, confirmed_at, unnest(range(0, 13)) AS widx FROM seeds"),
    ("snap", """SELECT sc.mmsi, sc.confirmed_at, CAST(sc.widx AS BIGINT) AS window_index,
        make_timestamp(epoch_us(sc.confirmed_at) - 365 * 86400000000 + sc.widx * 2592000000000) AS window_start,
        make_timestamp(least(epoch_us(sc.confirmed_at) - 365 * 86400000000 + (sc.widx + 1) * 2592000000000,
                             epoch_us(sc.confirmed_at))) AS window_end,
        CAST(365 - 30 * sc.widx AS BIGINT) AS days_before_confirmation,
        CAST(COALESCE(rs.g, 0) AS DOUBLE) AS ais_gap_count, CAST(COALESCE(rs.sts, 0) AS DOUBLE) AS sts_candidate_proxy,
        CASE WHEN rs.n > 0 THEN rs.low / rs.n ELSE 0.0 END AS low_sog_fraction,
        CAST(COALESCE(rs.n, 0) AS DOUBLE) AS record_count
      FROM scaf sc LEFT JOIN rs ON rs.mmsi = sc.mmsi AND rs.widx = sc.widx"""),
]


@register("rewind_windows", with_views("ais_positions", "vessel_reviews", extra=REWIND_CTES) + """SELECT mmsi,
  strftime(confirmed_at, '%Y-%m-%d %H:%M:%S.%f') AS confirmed_at, window_index,
  strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S.%f') AS window_end, days_before_confirmation, ais_gap_count, sts_candidate_proxy,
  round(low_sog_fraction, 6) AS low_sog_fraction, record_count FROM snap""")
def q_rewind_windows(spark, base):
    out = _rewind(spark, base)
    for c in ("confirmed_at", "window_start", "window_end"):
        out = out.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return finish(out)


@register("precursors", with_views("ais_positions", "vessel_reviews", extra=[
    *REWIND_CTES,
    ("pl", """SELECT mmsi, feature, r, b FROM (
        SELECT mmsi,
          avg(ais_gap_count) FILTER (WHERE days_before_confirmation <= 90) AS r1, avg(ais_gap_count) FILTER (WHERE days_before_confirmation > 90) AS b1,
          avg(sts_candidate_proxy) FILTER (WHERE days_before_confirmation <= 90) AS r2, avg(sts_candidate_proxy) FILTER (WHERE days_before_confirmation > 90) AS b2,
          avg(low_sog_fraction) FILTER (WHERE days_before_confirmation <= 90) AS r3, avg(low_sog_fraction) FILTER (WHERE days_before_confirmation > 90) AS b3
        FROM snap GROUP BY mmsi) t,
        LATERAL (VALUES ('ais_gap_count', r1, b1), ('sts_candidate_proxy', r2, b2), ('low_sog_fraction', r3, b3)) v(feature, r, b)"""),
]) + """SELECT mmsi, feature, round(r, 4) AS recent_value, round(b, 4) AS baseline_value, round(r / (b + 1e-9), 4) AS uplift_ratio
FROM pl WHERE r IS NOT NULL AND b IS NOT NULL AND r / (b + 1e-9) > 1.5""")
def q_precursors(spark, base):
    return finish(causal.precursor_signals(_rewind(spark, base)), 4)


@register("backtracking", with_views("ais_positions", "vessel_reviews", extra=[
    *REWIND_CTES,
    ("conf", f"""SELECT DISTINCT mmsi FROM vessel_reviews WHERE review_tier = 'confirmed'
        AND reviewed_at > {AS_OF} - INTERVAL 30 DAY AND reviewed_at <= {AS_OF}"""),
]) + """SELECT CAST(count(*) AS BIGINT) AS confirmed, CAST(count(r.mmsi) AS BIGINT) AS rewound,
  count(*) = count(r.mmsi) AS passed
FROM conf c LEFT JOIN (SELECT DISTINCT mmsi FROM snap) r ON r.mmsi = c.mmsi""")
def q_backtracking(spark, base):
    fx = Fixtures(spark, base)
    since = C.FIXTURE_AS_OF - dt.timedelta(days=30)
    return finish(causal.backtracking(fx.vessel_reviews, _rewind(spark, base), since, C.FIXTURE_AS_OF))
