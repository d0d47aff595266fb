"""the per-vessel feature matrix and its core-column gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import fusion, graph, identity, tracks
from ..session import cut_lineage

# FIXED VALUES: the 27 feature columns in output order with their defaults.
DEFAULTS = {
    "ais_gap_count_30d": 0,
    "ais_gap_max_hours": 0.0,
    "position_jump_count": 0,
    "sts_candidate_count": 0,
    "port_call_ratio": 0.5,
    "loitering_hours_30d": 0.0,
    "chokepoint_exit_gap_count": 0,
    "ais_pre_gap_regularity": 1.0,
    "imo_type_mismatch": False,
    "imo_scrapped_flag": False,
    "imo_under_construction_flag": False,
    "flag_changes_2y": 0,
    "name_changes_2y": 0,
    "owner_changes_2y": 0,
    "high_risk_flag_ratio": 0.0,
    "ownership_depth": 0,
    "sanctions_distance": 99,
    "cluster_sanctions_ratio": 0.0,
    "shared_manager_risk": 99,
    "shared_address_centrality": 0,
    "sts_hub_degree": 0,
    "route_cargo_mismatch": 0.0,
    "declared_vs_estimated_cargo_value": 0.0,
    "unmatched_sar_detections_30d": 0,
    "eo_dark_count_30d": 0,
    "eo_ais_mismatch_ratio": 0.0,
    "sanctions_list_count": 0,
}

# The columns by the family that works them out.
TRACK_COLUMNS = [
    "ais_gap_count_30d", "ais_gap_max_hours", "position_jump_count", "sts_candidate_count", "port_call_ratio",
    "loitering_hours_30d", "chokepoint_exit_gap_count", "ais_pre_gap_regularity",
]
IMO_COLUMNS = ["imo_type_mismatch", "imo_scrapped_flag", "imo_under_construction_flag"]
TRADE_COLUMNS = ["route_cargo_mismatch", "declared_vs_estimated_cargo_value"]
SAR_COLUMNS = ["unmatched_sar_detections_30d"]
EO_COLUMNS = ["eo_dark_count_30d", "eo_ais_mismatch_ratio"]
CHANGE_COLUMNS = ["flag_changes_2y", "name_changes_2y", "owner_changes_2y", "high_risk_flag_ratio", "ownership_depth"]
OWNERSHIP_COLUMNS = ["sanctions_distance", "cluster_sanctions_ratio", "shared_manager_risk", "shared_address_centrality"]

CORE_COLUMNS = [
    "ais_gap_count_30d", "position_jump_count", "sts_candidate_count", "loitering_hours_30d",
    "flag_changes_2y", "name_changes_2y", "owner_changes_2y", "sanctions_distance",
    "cluster_sanctions_ratio", "route_cargo_mismatch",
]


def build_feature_matrix(
    positions: DataFrame,
    vessel_meta: DataFrame,
    sanctions_entities: DataFrame,
    owned_by: DataFrame,
    managed_by: DataFrame,
    controlled_by: DataFrame,
    registered_in: DataFrame,
    registered_at: DataFrame,
    trade_flow: DataFrame,
    vessel_ref: DataFrame,
    sar: DataFrame | None = None,
    eo: DataFrame | None = None,
    as_of: dt.datetime = C.FIXTURE_AS_OF,
    window_days: int = C.DEFAULT_WINDOW_DAYS,
    skip_graph: bool = False,
    skip_eo: bool = False,
    deep_cells: DataFrame | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per vessel (positions in window ∪ registry), all 27 features with defaults.

    ``columns`` asks for some features only; families without any of them are not planned.
    Families are stacked and folded with one groupBy(mmsi). The direct-listing
    fallback, the program count and the STS degree are applied after the
    merge so vessels absent from the registry are covered too.
    """
    wanted = list(DEFAULTS) if columns is None else [c for c in DEFAULTS if c in columns]

    def asked(group: list[str]) -> bool:
        return any(c in wanted for c in group)

    window = tracks.position_window(positions, as_of, window_days)
    sensors = sar is not None and asked(SAR_COLUMNS) or eo is not None and not skip_eo and asked(EO_COLUMNS)
    if asked(TRACK_COLUMNS) or sensors:
        # The windowed positions and their lagged form feed every track and fusion
        # feature: shuffle once, write, and let each family read the same rows. A persisted
        # frame would put its own plan into each place that reads it.
        window = cut_lineage(window)
        lagged = cut_lineage(tracks.lagged_fixes(window))
    # All vessels, whatever families are asked for.
    parts = [window.select("mmsi").unionByName(vessel_meta.select("mmsi")).where(F.col("mmsi").isNotNull()).distinct()]
    if asked(TRACK_COLUMNS):
        parts.append(tracks.ais_features(window, deep_cells=deep_cells, lagged=lagged))
    if asked(TRADE_COLUMNS):
        parts.append(identity.trade_mismatch(vessel_meta, trade_flow))
    if asked(IMO_COLUMNS):
        parts.append(identity.imo_mismatch(vessel_meta, vessel_ref, as_of))
    if sar is not None and asked(SAR_COLUMNS):
        parts.append(fusion.unmatched_sar_detections(sar, lagged))
    if eo is not None and not skip_eo and asked(EO_COLUMNS):
        parts.append(fusion.eo_features(eo, lagged))
    if not skip_graph and asked(CHANGE_COLUMNS + OWNERSHIP_COLUMNS):
        g = graph.build_graph(vessel_meta, sanctions_entities, owned_by, managed_by, controlled_by,
                              registered_in, registered_at)
        if asked(CHANGE_COLUMNS):
            parts += graph.identity_parts(g)
        if asked(OWNERSHIP_COLUMNS):
            parts += graph.ownership_parts(g, sanctions_entities)
    if len(parts) > 1:
        # One plan of all families is too large for a driver: each is worked out by itself and written.
        parts = [cut_lineage(p) for p in parts]
    matrix = tracks.fold_by_key(parts, {k: DEFAULTS[k] for k in wanted})
    if not skip_graph:
        if "sanctions_distance" in wanted:
            matrix = graph.direct_sanctions_fallback(matrix, sanctions_entities)
        if "sanctions_list_count" in wanted:
            slc = cut_lineage(graph.sanctions_list_count(vessel_meta, sanctions_entities)).withColumnRenamed("sanctions_list_count", "_slc")
            matrix = matrix.join(slc, "mmsi", "left").withColumn("sanctions_list_count", F.coalesce("_slc", F.lit(0))).drop("_slc")
        if "sts_hub_degree" in wanted:
            deg = cut_lineage(tracks.sts_hub_degree(tracks.sts_contacts(positions, deep_cells, degrees=True))).withColumnRenamed("sts_hub_degree", "_deg")
            matrix = matrix.join(deg, "mmsi", "left").withColumn("sts_hub_degree", F.coalesce("_deg", F.col("sts_hub_degree"))).drop("_deg")
    return matrix.select("mmsi", *wanted)


def validate_core_columns(matrix: DataFrame, columns: list[str] = CORE_COLUMNS) -> DataFrame:
    """F15 as a report: one row (column, null_count); a non-empty filter result means failure."""
    agg = matrix.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, null_count)")
