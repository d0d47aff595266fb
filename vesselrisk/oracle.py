"""DuckDB SQL for the adapter views, used to build oracle queries.

``with_views("ais_positions", ...)`` returns a ``WITH`` prefix defining the
requested views (plus what they depend on) over the pre-registered driver
tables, so each oracle query is one self-contained SQL string.
"""

from __future__ import annotations

_FLAG_CASE = (
    "CASE {k} % 8 WHEN 0 THEN 'IR' WHEN 1 THEN 'RU' WHEN 2 THEN 'KP' WHEN 3 THEN 'SG' "
    "WHEN 4 THEN 'PA' WHEN 5 THEN 'KM' WHEN 6 THEN 'VE' ELSE 'LR' END"
)

VIEWS: dict[str, str] = {
    "ais_positions": """
SELECT CAST(200000000 + user_id AS VARCHAR) AS mmsi, ts AS timestamp,
       CAST(1.0 AS DOUBLE) + (k % 10) * CAST(0.5 AS DOUBLE) AS lat,
       CAST(103.5 AS DOUBLE) + (k // 10) * CAST(0.001 AS DOUBLE) AS lon,
       least(value / 10, CAST(30.0 AS DOUBLE)) AS sog, CAST(k AS DOUBLE) * 3.6 AS cog,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 5
                       WHEN 'signup' THEN 3 ELSE 8 END AS nav_status,
       CASE user_id % 5 WHEN 0 THEN 82 WHEN 1 THEN 70 WHEN 2 THEN 60 WHEN 3 THEN 52 ELSE 30 END AS ship_type,
       event_id
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "vessel_meta": f"""
SELECT CAST(200000000 + c_custkey AS VARCHAR) AS mmsi, CAST(9000000 + c_custkey AS VARCHAR) AS imo,
       c_name AS name, {_FLAG_CASE.format(k='c_nationkey')} AS flag,
       CASE c_custkey % 5 WHEN 0 THEN 82 WHEN 1 THEN 70 WHEN 2 THEN 60 WHEN 3 THEN 52 ELSE 30 END AS ship_type
FROM customer""",
    "detections": """
SELECT 'D' || event_id AS detection_id,
       timestamp + CASE WHEN nav_status IN (0, 5) THEN INTERVAL 20 MINUTES ELSE INTERVAL 5 HOURS END AS detected_at,
       lat + CASE WHEN nav_status IN (0, 5) THEN CAST(0.02 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS lat, lon
FROM ais_positions""",
    "sanctions_entities": """
SELECT 'S' || s_suppkey AS entity_id, s_name AS name, CAST(NULL AS VARCHAR) AS mmsi, CAST(NULL AS VARCHAR) AS imo,
       CAST(NULL AS VARCHAR) AS flag, 'Company' AS type,
       CASE s_suppkey % 3 WHEN 0 THEN 'us_ofac_sdn;eu_fsf' WHEN 1 THEN 'un_sc_sanctions'
            ELSE 'us_ofac_sdn' END AS list_source
FROM supplier WHERE s_acctbal < 500
UNION ALL
SELECT 'V' || c_custkey, c_name, CAST(200000000 + c_custkey AS VARCHAR), CAST(9000000 + c_custkey AS VARCHAR),
       NULL, 'Vessel', CASE c_custkey % 2 WHEN 0 THEN 'us_ofac_sdn' ELSE 'eu_fsf;us_ofac_sdn' END
FROM customer WHERE c_acctbal < -700""",
    "owned_by": """
SELECT DISTINCT CAST(200000000 + o_custkey AS VARCHAR) AS src_id, 'S' || l_suppkey AS dst_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1 AND o_orderpriority = '1-URGENT'""",
    "managed_by": """
SELECT DISTINCT CAST(200000000 + o_custkey AS VARCHAR) AS src_id, 'S' || l_suppkey AS dst_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 2 AND o_orderpriority = '2-HIGH'""",
    "controlled_by": """
SELECT 'S' || s_suppkey AS src_id, 'S' || (s_suppkey // 3) AS dst_id FROM supplier WHERE s_suppkey > 0""",
    "registered_in": f"""
SELECT 'S' || s_suppkey AS src_id, {_FLAG_CASE.format(k='s_nationkey')} AS dst_id FROM supplier""",
    "registered_at": """
SELECT 'S' || s_suppkey AS src_id, 'A' || (s_suppkey % 17) AS dst_id FROM supplier""",
    "trade_flow": """
SELECT '702' AS reporter,
       CASE c_nationkey % 8 WHEN 0 THEN 'IR' WHEN 1 THEN 'RU' WHEN 4 THEN 'PA' ELSE 'SG' END AS partner,
       '2709' AS hs_code, '1996' AS period, round(sum(o_totalprice), 2) AS trade_value_usd
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY ALL""",
    "equasis_vessel_ref": """
SELECT CAST(9000000 + c_custkey AS VARCHAR) AS imo,
       CASE c_custkey % 7 WHEN 0 THEN 82 WHEN 1 THEN 70 WHEN 2 THEN 60 WHEN 3 THEN 0 ELSE 30 END AS vessel_type,
       1980 + c_custkey % 50 AS build_year, c_custkey % 23 = 0 AS scrapped
FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "vessel_reviews": """
SELECT CAST(200000000 + user_id AS VARCHAR) AS mmsi,
       CASE event_type WHEN 'purchase' THEN 'confirmed' WHEN 'signup' THEN 'probable' WHEN 'click' THEN 'suspect'
            WHEN 'view' THEN 'cleared' ELSE 'inconclusive' END AS review_tier,
       ts AS reviewed_at
FROM events""",
    "ranked_items": """
SELECT CAST(d.doc_id AS VARCHAR) AS mmsi, d.source AS vessel_type, d.lang AS region,
       (d.n_chars % 1000) / CAST(1000 AS DOUBLE) AS confidence, l.quality AS y_true
FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "designations": """
SELECT CAST(200000000 + c_custkey AS VARCHAR) AS mmsi,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 90 AS INTEGER)) - to_days(30) AS first_seen
FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')""",
}

DEPENDS = {"detections": ["ais_positions"]}


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    if not names and not extra:
        return ""
    """``WITH`` prefix defining the named views (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in order]
    for n, sql in extra or []:
        parts.append(f"{n} AS ({sql.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
