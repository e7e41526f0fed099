"""Key names, table schemas, configuration and plan-time validation (G1)."""

from __future__ import annotations

from dataclasses import dataclass, field
from numbers import Real

from pyspark.sql import DataFrame
from pyspark.sql import types as T

K = ["acquisition_id", "channel"]
OBJ = [*K, "object_id"]
KP = ["acquisition_id", "channel_a", "channel_b"]
PAIR = [*KP, "object_a", "object_b"]

# Default calibration, thresholds, rule vocabulary.
PIXEL_SIZE_X_UM = 0.312843137
PIXEL_SIZE_Y_UM = 0.312836345
INTENSITY_METRICS = ("mean_intensity", "median_intensity", "max_intensity",
                     "integrated_intensity", "intensity_sd")
SHAPE_METRICS = ("area_px", "area_um2", "perimeter_um", "convex_hull_area_um2", "solidity",
                 "circularity", "eccentricity", "extent", "major_axis_um", "minor_axis_um",
                 "aspect_ratio", "equivalent_diameter_um")

ROI_PIXELS = T.StructType([
    T.StructField("acquisition_id", T.StringType(), False),
    T.StructField("channel", T.StringType(), False),
    T.StructField("object_id", T.LongType(), False),
    T.StructField("x", T.LongType(), False),
    T.StructField("y", T.LongType(), False),
])

OBJECT_MEASUREMENTS = T.StructType([
    T.StructField("ImageNumber", T.LongType()),
    T.StructField("ObjectNumber", T.LongType()),
    T.StructField("AreaShape_Area", T.DoubleType()),
    T.StructField("AreaShape_BoundingBoxMinimum_X", T.DoubleType()),
    T.StructField("AreaShape_BoundingBoxMaximum_X", T.DoubleType()),
    T.StructField("AreaShape_BoundingBoxMinimum_Y", T.DoubleType()),
    T.StructField("AreaShape_BoundingBoxMaximum_Y", T.DoubleType()),
    T.StructField("AreaShape_Center_X", T.DoubleType()),
    T.StructField("AreaShape_Center_Y", T.DoubleType()),
])


def require_columns(df: DataFrame, columns: list[str] | set[str], label: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks required columns {missing}")


@dataclass(frozen=True)
class Rule:
    """One percentile gate; percentile 0 switches the rule off."""

    metric: str
    percentile: float
    keep: str = "above"


def validate_rules(rules: list[Rule], allowed: tuple[str, ...]) -> list[Rule]:
    """Plan-time checks; returns the enabled rules."""
    seen = set()
    for rule in rules:
        if rule.metric not in allowed:
            raise ValueError(f"metric {rule.metric!r} does not belong to this pass")
        if rule.metric in seen:
            raise ValueError(f"metric {rule.metric!r} has two rules")
        seen.add(rule.metric)
        if isinstance(rule.percentile, bool) or not isinstance(rule.percentile, Real):
            raise ValueError(f"percentile of {rule.metric!r} must be a number")
        if not 0 <= rule.percentile <= 100:
            raise ValueError(f"percentile of {rule.metric!r} must lie in [0, 100]")
        if rule.keep not in ("above", "below"):
            raise ValueError(f"keep of {rule.metric!r} must be 'above' or 'below'")
    return [r for r in rules if r.percentile > 0]


def validate_pairs(pairs: list[tuple], known: set | None = None) -> list[tuple]:
    """Directional channel pairs: no self pair, no duplicate, only known channels."""
    for pair in pairs:
        if len(pair) != 2 or pair[0] == pair[1]:
            raise ValueError(f"a pair needs two different channels, got {pair!r}")
        if known is not None and not set(pair) <= known:
            raise ValueError(f"pair {pair!r} names an unknown channel")
    if len(set(pairs)) != len(pairs):
        raise ValueError("duplicate directional pair")
    return pairs


def validate_threshold(value: float) -> float:
    if isinstance(value, bool) or not isinstance(value, Real) or not 0 <= value <= 1:
        raise ValueError(f"threshold must lie in [0, 1], got {value!r}")
    return float(value)


@dataclass(frozen=True)
class AnalysisConfig:
    """Everything a run needs besides its tables."""

    nuclear_channel: object
    marker_nuclear_threshold: float
    marker_marker_threshold: float
    marker_pairs: list[tuple]
    intensity_rules: list[Rule] = field(default_factory=list)
    shape_rules: list[Rule] = field(default_factory=list)

    def __post_init__(self):
        validate_threshold(self.marker_nuclear_threshold)
        validate_threshold(self.marker_marker_threshold)
        validate_pairs(self.marker_pairs)
        validate_rules(self.intensity_rules, INTENSITY_METRICS)
        validate_rules(self.shape_rules, SHAPE_METRICS)
