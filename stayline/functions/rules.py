"""Risk level, value segment and journey stage as column expressions."""

from pyspark.sql import functions as F

# Fixed thresholds.
CRITICAL, HIGH, MEDIUM = 0.75, 0.5, 0.3
VIP_REVENUE, VIP_TENURE = 100.0, 36


def risk_level(p, critical=CRITICAL, high=HIGH, medium=MEDIUM):
    return (
        F.when(p >= critical, "critical")
        .when(p >= high, "high")
        .when(p >= medium, "medium")
        .otherwise("low")
    )


def segment(revenue, tenure, p, services, vip_revenue=VIP_REVENUE, vip_tenure=VIP_TENURE):
    return (
        F.when((revenue >= vip_revenue) & (tenure >= vip_tenure), "vip")
        .when((tenure >= 24) & (revenue >= 50), "loyal")
        .when((tenure < 12) & (revenue >= 80), "growing")
        .when((p >= 0.5) & (revenue >= 50), "at_risk")
        .when(tenure < 6, "new")
        .when((services <= 2) & (revenue < 50), "disengaged")
        .when(p >= 0.5, "at_risk")
        .otherwise("loyal")
    )


def journey_stage(tenure, p):
    return (
        F.when(p >= CRITICAL, "at_risk")
        .when((tenure >= 0) & (tenure < 3), "acquisition")
        .when((tenure >= 3) & (tenure < 6), "onboarding")
        .when((tenure >= 6) & (tenure < 12), "growth")
        .when((tenure >= 12) & (tenure < 24), "maturity")
        .otherwise("retention")
    )


def title_case(col):
    """`at_risk` to `At Risk`."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def text_table(rows):
    """Literal map from a dict of strings."""
    return F.create_map(*[F.lit(x) for pair in rows.items() for x in pair])
