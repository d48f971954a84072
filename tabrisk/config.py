"""Column roles, label rules, encodings and feature-group registry.

Everything here is plain configuration; operators take these values as
defaults and accept overrides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# --------------------------------------------------------------------------
NUMERIC_COLS = [
    "elevation_m",
    "drainage_density_km_per_km2",
    "storm_drain_proximity_m",
    "historical_rainfall_intensity_mm_hr",
    "return_period_years",
]
CATEGORICAL_COLS = ["land_use", "soil_group", "storm_drain_type", "rainfall_source", "dem_source"]
DROP_COLS = ["segment_id", "city_name", "admin_ward", "catchment_id", "risk_labels"]
METADATA_COLS = ["risk_class", "risk_class_encoded", "latitude", "longitude"]
LABEL_COL = "risk_labels"
TARGET_COL = "risk_class"

# Ordered label rules: the first rule with a matching token wins; default Low.
LABEL_RULES = [
    ("High", ["ponding_hotspot", "extreme_rain_history"]),
    ("Medium", ["low_lying", "sparse_drainage"]),
]
DEFAULT_CLASS = "Low"
CLASS_TO_CODE = {"Low": 0, "Medium": 1, "High": 2}
CLASS_NAMES = ["Low", "Medium", "High"]
EVENT_TOKEN_PATTERN = r"^event_\d{4}-\d{2}-\d{2}"

ELEVATION_SENTINEL = -3.0
ELEV_LOW_FALLBACK = 5.0
ELEV_MISSING_FILL = 999.0
DIVISION_EPS = 1e-5
CLIP_UPPER_QUANTILE = 0.95
ELEV_LOW_QUANTILE = 0.10
UNKNOWN_CATEGORY = "Unknown"

# Core soil code (tree and G3 features): Unknown 0, A 1, B 2, C 3, D 4.
SOIL_CODE_CORE = {"Unknown": 0, "A": 1, "B": 2, "C": 3, "D": 4}
# Domain soil code: A 0, B 1, C 2, D 3, Unknown missing.
SOIL_CODE_DOMAIN = {"A": 0, "B": 1, "C": 2, "D": 3}
# Ordinal order used by the linear preparation for soil_group.
SOIL_ORDER = ["Unknown", "A", "B", "C", "D"]
ORDINAL_COLS = ["soil_group"]
OHE_COLS = ["land_use", "storm_drain_type", "rainfall_source", "dem_source"]

BASE_SKEW_COLS = [
    "elevation_m",
    "storm_drain_proximity_m",
    "historical_rainfall_intensity_mm_hr",
    "return_period_years",
]
ENGINEERED_SKEW_COLS = ["G1_infra_vuln", "G2_rain_x_return", "G3_soil_x_rainfall"]
SKEW_THRESHOLD = 0.5

CORE_GROUP_COLS = {
    "G1": "G1_infra_vuln",
    "G2": "G2_rain_x_return",
    "G3": "G3_soil_x_rainfall",
    "G4": "G4_is_very_low_elev",
}
DOMAIN_GROUP_COLS = {
    "G1": ["G1_drainage_deficit", "G1_infra_vuln"],
    "G2": ["G2_hydraulic_stress", "G2_flood_accum"],
    "G3": ["G3_effective_runoff", "G3_soil_elev_risk"],
    "G4": ["G4_elev_pct_rank", "G4_rain_pct_rank", "G4_compound_extreme"],
    "G5": ["G5_is_tropical", "G5_abs_latitude"],
    "G6": ["G6_log_elevation", "G6_log_rainfall", "G6_log_rain_x_return"],
}
TROPIC_LATITUDE = 23.5

# Right-closed elevation bins used in profiling.
ELEVATION_BIN_EDGES = [5.0, 20.0, 50.0]
ELEVATION_BIN_LABELS = ["<=5", "5-20", "20-50", ">50"]

# Explicit class weights used by the "weighted" strategy.
DEFAULT_CLASS_WEIGHTS = {0: 1.0, 1: 1.5, 2: 2.0}

# Overfit and skew severity thresholds.
OVERFIT_GAP = 0.1
OVERFIT_GAP_WARN = 0.05
SKEW_HEAVY = 1.0
SKEW_MODERATE = 0.5
CORR_FLAG = 0.3
SPARSE_COEF = 1e-4

# Focal loss defaults.
FOCAL_ALPHA = 0.25
FOCAL_GAMMA = 2.0

# Leaderboard sort keys.
LEADERBOARD_KEYS = ["f2_macro", "f1_weighted"]


@dataclass
class PrepConfig:
    """Switches of the preparation flows."""

    fe_groups: list = field(default_factory=lambda: ["G1", "G2", "G3", "G4"])
    clip_upper_q: float = CLIP_UPPER_QUANTILE
    use_skew: bool = True
    use_scale: bool = True
    use_ohe: bool = True
    skew_threshold: float = SKEW_THRESHOLD
