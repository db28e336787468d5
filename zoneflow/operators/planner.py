"""Scenario planning and recommendations on the zone risk table."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLANNED_ZONES = 25
# Texts of the recommendations.
REVIEW, MONITOR = "Prioritize workload-risk review", "Monitor recurring demand pattern"

# What each assumption means.
MEANINGS = {
    "available_staff_resources": "Total resources available for the scenario",
    "target_demand_coverage_pct": "Target share of projected workload to cover",
    "expected_demand_increase_pct": "Planning increase over observed demand",
    "weather_event_demand_multiplier": "Multiplier for weather/event-sensitive periods",
    "high_risk_threshold": "Risk score threshold for high-risk zones",
    "max_capacity_per_resource": "Demand units one resource can cover",
    "minimum_coverage_target": "Minimum acceptable projected coverage",
}

# Recommendations; {zone} and {category} stand for the leading zone and category.
RECOMMENDATIONS = [
    ("REC-001", "Demand-spike alerting", "Command center leaders",
     "High workload-risk concentration in {zone}",
     "Create configurable zone-hour alerts for emerging demand spikes.", "High"),
    ("REC-002", "Zone-level workload-risk scoring", "Client service and operations teams",
     "Risk score blends demand volume, volatility, weekend, and after-hours patterns.",
     "Use a recurring workload-risk view during client service reviews.", "High"),
    ("REC-003", "Command-center demand heatmap", "Supervisors and service managers",
     "Demand differs materially by hour, weekday, and zone.",
     "Build heatmap widgets for time-of-week and zone demand visibility.", "High"),
    ("REC-004", "Category mix trend monitoring", "Product managers",
     "{category} is a major workload driver in this run.",
     "Track category mix changes to prioritize workflow and reporting enhancements.", "Medium"),
    ("REC-005", "Staffing/resource scenario planner", "Business operations analysts",
     "High-demand zone-hours can be forecasted from historical patterns.",
     "Use Excel/Hex planning tools for coverage gap and allocation scenarios.", "High"),
    ("REC-006", "Weather-aware demand monitoring", "Client service teams",
     "Weather features are joined at hourly granularity.",
     "Surface precipitation and temperature context in service-demand reviews.", "Medium"),
    ("REC-007", "Recurring demand pattern packet", "Account and product teams",
     "Monthly, weekend, and after-hours patterns can be refreshed locally.",
     "Generate a recurring service-demand trend packet for stakeholder updates.", "Medium"),
    ("REC-008", "Territory workload review workflow", "Operations planning teams",
     "Cluster profiles segment zones into interpretable demand profiles.",
     "Use clusters to guide territory/zone workload review conversations.", "Medium"),
]
RECOMMENDATION_COLUMNS = [
    "recommendation_id", "recommendation_theme", "target_user", "evidence_signal",
    "product_service_opportunity", "priority",
]


@dataclass(frozen=True)
class Assumptions:
    """Inputs of a scenario, with the usual starting values."""

    available_staff_resources: float = 30
    target_demand_coverage_pct: float = 0.85
    expected_demand_increase_pct: float = 0.10
    weather_event_demand_multiplier: float = 1.05
    high_risk_threshold: float = 70
    max_capacity_per_resource: float = 12
    minimum_coverage_target: float = 0.75


def assumptions_table(spark: SparkSession, inputs: Assumptions = Assumptions()) -> DataFrame:
    """Each assumption with its value and meaning."""
    values = asdict(inputs)
    rows = [(f.name, float(values[f.name]), MEANINGS[f.name]) for f in fields(inputs)]
    return spark.createDataFrame(rows, "input string, value double, description string")


def plan(zones: DataFrame, inputs: Assumptions = Assumptions(), n: int = PLANNED_ZONES) -> DataFrame:
    """Resource plan for the n zones with the highest risk score.

    Weights are shares of the score total over these n rows, the only rows the
    window sees.
    """
    top = zones.select(
        "zone_id",
        F.coalesce(F.col("total_events").cast("double"), F.lit(0.0)).alias("baseline_events"),
        F.coalesce("workload_risk_score", F.lit(0.0)).alias("workload_risk_score"),
    ).orderBy(F.desc("workload_risk_score"), "zone_id").limit(n)
    risk, projected, allocated = (
        F.col(c) for c in ("workload_risk_score", "projected_demand", "allocated_resources")
    )
    growth = (1 + inputs.expected_demand_increase_pct) * inputs.weather_event_demand_multiplier
    wanted = projected * inputs.target_demand_coverage_pct
    whole = W.partitionBy(F.lit(1))
    return (
        top.withColumns(
            {
                "priority_weight": F.try_divide(risk, F.sum(risk).over(whole)),
                "projected_demand": F.col("baseline_events") * growth,
            }
        )
        .withColumns(
            {
                "resources_needed": wanted / inputs.max_capacity_per_resource,
                "allocated_resources": F.col("priority_weight") * inputs.available_staff_resources,
            }
        )
        .withColumn("projected_capacity", allocated * inputs.max_capacity_per_resource)
        .withColumns(
            {
                "workload_gap": F.greatest(wanted - F.col("projected_capacity"), F.lit(0.0)),
                "coverage_pct": F.when(projected == 0, 0.0).otherwise(F.col("projected_capacity") / projected),
                "recommendation_text": F.when(risk >= inputs.high_risk_threshold, REVIEW).otherwise(MONITOR),
            }
        )
    )


def recommendations(risk: DataFrame, categories: DataFrame) -> DataFrame:
    """Eight recommendations with the leading zone and category filled in."""
    def leader(df, name, measure):
        return df.agg(F.min_by(name, F.struct(-F.col(measure), F.col(name)))).scalar()

    texts = risk.sparkSession.createDataFrame(RECOMMENDATIONS, ", ".join(f"{c} string" for c in RECOMMENDATION_COLUMNS))
    zone = F.coalesce(leader(risk, "zone_id", "workload_risk_score"), F.lit("highest-risk zones"))
    category = F.coalesce(
        leader(categories, "normalized_service_category", "demand_count"), F.lit("top service categories")
    )
    signal = F.replace(
        F.replace(F.col("evidence_signal"), F.lit("{zone}"), zone), F.lit("{category}"), category
    )
    return texts.withColumn("evidence_signal", signal)
