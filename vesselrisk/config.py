"""Fixed values that must equal the behaviour being reproduced.

Everything here is a plain constant: thresholds, code lists and boxes. They are
listed together, in natural order, so they can be audited in one place.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES — track behaviour
# ---------------------------------------------------------------------------
GAP_THRESHOLD_H = 10.0            # F1, F6, F9 gap threshold (hours)
EO_GAP_THRESHOLD_H = 6.0          # F10 gap threshold (hours)
CAUSAL_GAP_THRESHOLD_H = 6.0      # C1, C7, C8, C11 gap threshold (hours)
JUMP_SPEED_KNOTS = 50.0
LOITER_SPEED_KNOTS = 2.0
STOPPED_STATUSES = (0, 1, 3, 5)
PORT_MOORED_STATUS = 5
KM_PER_NM = 1.852
EARTH_RADIUS_KM = 6371.0
DEFAULT_WINDOW_DAYS = 60
STS_BUCKET_MINUTES = 30
STS_MIN_CO_LOCATIONS = 2

# Chokepoint exits (lat, lon, name) and the 50 nm radius around them.
CHOKEPOINT_EXITS = (
    (1.16, 104.4, "singapore_east"),
    (1.28, 103.5, "singapore_west"),
    (6.5, 99.8, "malacca_north"),
    (26.5, 57.2, "hormuz_east"),
    (12.4, 43.6, "babelMandeb_south"),
    (29.9, 32.6, "suez_south"),
    (36.2, 28.0, "aegean_south"),
    (-34.0, 18.4, "capetown"),
)
CHOKEPOINT_EXIT_RADIUS_KM = 50.0 * 1.852
PRE_GAP_WINDOW_H = 6.0

# ---------------------------------------------------------------------------
# FIXED VALUES — SAR / EO fusion
# ---------------------------------------------------------------------------
SAR_MATCH_RADIUS_KM = 5.0
SAR_MATCH_WINDOW_MIN = 60
SAR_ATTRIBUTION_RADIUS_KM = 50.0
KM_PER_DEG_LAT = 111.0            # box prefilter: lat tolerance = km / 111
KM_PER_DEG_LON_45 = 78.0          # box prefilter: lon tolerance = 2 * km / 78
EO_MATCH_RADIUS_DEG = 0.1
EO_MATCH_WINDOW_MIN = 120
EO_ATTRIBUTION_RADIUS_DEG = 0.5

# ---------------------------------------------------------------------------
# FIXED VALUES — identity, trade, graph
# ---------------------------------------------------------------------------
HIGH_RISK_FLAGS = ("KP", "IR", "VE", "SY", "CU", "KM", "GA", "CM", "PW", "KI", "TG", "SL", "ST")
SANCTIONED_EXPORTERS = ("KP", "IR", "VE", "SY", "CU", "RU")
TANKER_TYPES = tuple(range(80, 90))
TRADE_REPORTER = "702"
TRADE_HS_CODE = "2709"
COMPANY_TYPES = ("Company", "Organization", "LegalEntity")
MAX_HOPS = 99
OWNERSHIP_MAX_CONTROL_HOPS = 5
SERVICE_VESSEL_TYPES = (31, 32, 51, 52, 53, 54, 55, 56, 57, 58, 59)

# ---------------------------------------------------------------------------
# FIXED VALUES — scoring weights
# ---------------------------------------------------------------------------
ANOMALY_WEIGHT = 0.35
GRAPH_WEIGHT = 0.55
IDENTITY_WEIGHT = 0.10
ANOMALY_NORM_WEIGHT = 0.65
ANOMALY_NOISE_WEIGHT = 0.35
GRAPH_RISK_WEIGHTS = {"sanctions": 0.45, "cluster": 0.25, "manager": 0.10, "sts": 0.10, "lists": 0.10}
IDENTITY_WEIGHTS = {"names": 0.40, "owners": 0.30, "flag_ratio": 0.20, "depth": 0.10}

# Label propagation confidences: seed, owner peer, manager peer, STS peer.
PROPAGATION_SEED = 1.0
PROPAGATION_OWNER = 0.65
PROPAGATION_MANAGER = 0.60
PROPAGATION_STS = 0.50

# ---------------------------------------------------------------------------
# FIXED VALUES — causal / drift / lead time
# ---------------------------------------------------------------------------
DID_PRE_DAYS = 30
DID_POST_DAYS = 30
DID_ALPHA = 0.05
DEFAULT_GRAPH_WEIGHT = 0.40
REWIND_DAYS = 365
REWIND_INTERVAL_DAYS = 30
PRECURSOR_WINDOW_DAYS = 90
PRECURSOR_UPLIFT = 1.5
LEAD_FLAGGED_CONFIDENCE = 0.25
LEAD_UNKNOWN_CONFIDENCE = 0.30
# Drift thresholds (warn, critical).
DRIFT_FLAGS = (0.10, 0.25)
DRIFT_GAPS = (0.30, 0.60)
DRIFT_SCORE = (0.08, 0.15)
DRIFT_PRECISION = (0.10, 0.20)

# Corridors (id, lat_min, lat_max, lon_min, lon_max) in first-match order.
CORRIDORS = (
    (1, -6.0, 6.0, 98.0, 110.0),
    (2, 22.0, 30.0, 48.0, 62.0),
    (3, 10.0, 22.0, 32.0, 52.0),
    (4, 50.0, 65.0, -5.0, 30.0),
    (5, 14.0, 30.0, -100.0, -60.0),
    (6, 24.0, 40.0, 118.0, 130.0),
)

# Default "now" for the driver fixtures (events span 2024-01-01 .. 2024-01-30).
FIXTURE_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)

# FIXED VALUES: sanction regimes (key, label, list-source substring, flag filter,
# announcement dates). The substring is kept for reference only: treatment groups
# do not depend on the regime.
SANCTION_REGIMES = (
    ("OFAC_Iran", "OFAC Iran", "us_ofac_sdn", ("IR", ""), ("2012-03-15", "2019-05-08", "2020-01-10")),
    ("OFAC_Russia", "OFAC Russia", "us_ofac_sdn", ("RU", ""), ("2022-02-24", "2022-09-15", "2023-02-24")),
    ("UN_DPRK", "UN DPRK", "un_sc_sanctions", ("KP", ""), ("2017-08-05", "2017-09-11", "2017-12-22")),
)
DID_Z95 = 1.959964
UNKNOWN_RECENT_DAYS = 30
UNKNOWN_BASELINE_DAYS = 90
UNKNOWN_UPLIFT = 1.5
UNKNOWN_MIN_STS = 3
UNKNOWN_MIN_FLAG_CHANGES = 2
REWIND_STS_STATUSES = (0, 1, 3)
REWIND_LOW_SOG = 2.0

# FIXED VALUES: landing regions (name, lat_min, lon_min, lat_max, lon_max), first match wins.
REGIONS = (
    ("singapore", -5, 92, 22, 122),
    ("japansea", 25, 115, 48, 145),
    ("blacksea", 40, 27, 48, 42),
    ("europe", 35, -10, 65, 30),
    ("middleeast", 10, 32, 32, 62),
    ("persiangulf", 20, 48, 30, 65),
    ("gulfofguinea", -5, -5, 10, 10),
    ("gulfofaden", 10, 42, 16, 52),
    ("gulfofmexico", 18, -98, 31, -80),
    ("hornofafrica", -5, 40, 15, 55),
)
ACTIVE_REGIONS = ("japansea", "singapore", "europe", "blacksea", "middleeast", "gulfofguinea")
MIN_ACTIVE_REGIONS = 6
DQ_STALE_HOURS = 48

# FIXED VALUES: news context (X1) and BM25 parameters of the full-text index.
NEWS_RESULTS = 3
NEWS_CANDIDATE_FACTOR = 3
NEWS_NAME_TOKENS = 2
NEWS_MIN_TOKEN_LEN = 3
BM25_K1 = 1.2
BM25_B = 0.75
