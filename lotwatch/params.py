"""Tunable thresholds, passed explicitly to every operator that needs them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DetectionParams:
    # Cut points of the alerting rules.
    flag_threshold: float = 2.5
    borderline_low: float = 1.8
    min_units: int = 50
    high_risk_factor: float = 0.85
    rate_threshold: float = 0.038
    contamination: float = 0.1
    min_outlier_rows: int = 5
    outlier_trees: int = 100
    outlier_sample: int = 256
    default_tier: str = "UNKNOWN"
    default_composite: float = 0.8


@dataclass(frozen=True)
class RootCauseParams:
    # Confidence gates and evidence-source routing.
    min_confidence: float = 0.50
    max_sources: int = 3
    tier_high: float = 0.70
    tier_medium: float = 0.50
    heavy_defect_count: float = 40.0
    recent_months: int = 6


# Which evidence is consulted for each defect type.
EVIDENCE_SOURCES = {
    "seam_bulge": ["production_conditions", "material_lot", "supplier_history"],
    "heat_transfer_failure": ["material_lot", "supplier_history", "production_conditions"],
    "material_deformation": ["supplier_history", "material_lot"],
    "minor_thread": ["production_conditions"],
    "minor_color_variation": ["supplier_history"],
    "none": [],
}
DEFAULT_SOURCES = ["supplier_history", "material_lot"]

# Confidence assigned to each hypothesis (strong signal, weak signal).
SEAM_CONFIDENCE = (0.82, 0.71)
HEAT_CONFIDENCE = (0.78, 0.63)
FALLBACK_CONFIDENCE = 0.61


@dataclass(frozen=True)
class Scenario:
    name: str
    label: str
    return_rate_multiplier: float
    cost_per_unit: float
    fixed_cost: float
    brand_factor: float
    timeline_mean: float
    timeline_std: float


# The three response strategies.
SCENARIOS = (
    Scenario("do_nothing", "Do Nothing", 1.0, 0.0, 0.0, 3.0, 90.5, 17.0),
    Scenario("partial_remediation", "Partial Remediation", 0.40, 8.50, 85_000.0, 0.5, 44.7, 9.0),
    Scenario("full_recall", "Full Recall", 0.0, 22.00, 220_000.0, 0.2, 74.5, 15.0),
)
# Return-rate variants of the response scenarios.
RETURN_RATE_VARIANTS = (0.70, 0.85, 1.00, 1.15, 1.30)

# Expected cost in USD at each of the six response stages.
ROI_STAGES = (
    "Pre-Production Risk Scoring",
    "In-Production Lot Monitoring",
    "Defect Detection (AI Agent)",
    "RCA & Scenario Analysis",
    "Remediation Execution",
    "Reputational Recovery",
)
ROI_STAGE_COSTS = {
    "detect_early": (15_000, 25_000, 30_000, 40_000, 350_000, 420_000),
    "detect_late": (0, 0, 0, 250_000, 1_200_000, 1_850_000),
    "do_nothing": (0, 0, 0, 0, 580_000, 2_600_000),
    "ai_investment": (15_000, 25_000, 30_000, 40_000, 350_000, 420_000),
}


@dataclass(frozen=True)
class ScenarioParams:
    # Pricing, band width and sample-size gate.
    avg_unit_price: float = 85.0
    band: float = 0.08
    min_sample: int = 10_000
    reference_scenario: str = "detect_late"
    scenarios: tuple[Scenario, ...] = SCENARIOS


@dataclass(frozen=True)
class SummaryParams:
    # Briefing trigger and claim tolerance.
    severity_units: int = 5000
    severity_rate: float = 0.03
    claim_tolerance: float = 0.05


@dataclass(frozen=True)
class IngestParams:
    # Fixed value: a file with a larger share of invalid rows is held back whole.
    file_failure_rate: float = 0.30
    preview_ids: int = 20


@dataclass(frozen=True)
class Domains:
    """Value sets of the business rules; SKU and channel codes are the user's own."""

    skus: tuple[str, ...] = ()
    channels: tuple[str, ...] = ()
    # Line codes, inspection verdicts and unit limits.
    lines: tuple[str, ...] = ("L1", "L2", "L3", "L4")
    verdicts: tuple[str, ...] = ("PASS", "REVIEW", "FAIL")
    min_batch_units: int = 100
    max_batch_units: int = 5000
    min_inspected: int = 10


@dataclass(frozen=True)
class RiskParams:
    # Cut points on the composite score (higher is safer), and its dimensions.
    high_below: float = 0.70
    elevated_below: float = 0.78
    dimensions: tuple[str, ...] = field(
        default=(
            "historical_defect_score",
            "on_time_delivery_score",
            "audit_score",
            "material_lot_stability_score",
            "capacity_utilization_score",
        )
    )
