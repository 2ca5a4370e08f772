"""Alert rows from drift and performance results, and the alert log."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators.performance import WATCHED, keep_last


# Fixed texts of the alerts.
DRIFT_TITLE = "Data Drift Detected"
DRIFT_TEXTS = "Drift detected with severity: ", "\nFeatures with drift: "
PREDICTION_TEXT, LABEL_TEXT = "Prediction drift detected\n", "Label drift detected\n"
DEGRADED_TITLE = "Model Performance Degradation Detected"
DEGRADED_TEXTS = "Performance degradation detected with severity: ", "\nMetric changes:\n"


def _level(severity):
    return F.array_position(F.array(*[F.lit(s) for s in S.SEVERITIES]), severity)


def _reaches(severity, threshold):
    return _level(severity) >= S.SEVERITIES.index(threshold) + 1


def drift_alerts(summary, threshold="low"):
    """One alert if drift was found and its highest severity reaches the threshold."""
    worst = F.col("max_severity")
    message = F.concat(
        F.lit(DRIFT_TEXTS[0]), worst,
        F.lit(DRIFT_TEXTS[1]), F.col("features_with_drift").cast("string"),
        F.lit("/"), F.col("features_checked").cast("string"), F.lit("\n"),
        F.when(F.col("prediction_drift"), PREDICTION_TEXT).otherwise(""),
        F.when(F.col("label_drift"), LABEL_TEXT).otherwise(""),
    )
    return summary.where(F.col("overall_drift") & _reaches(worst, threshold)).select(
        F.lit(DRIFT_TITLE).alias("title"),
        message.alias("message"),
        F.when(worst == "high", "high").otherwise("medium").alias("severity"),
        F.to_json(F.struct(*summary.columns)).alias("metadata"),
    )


def performance_alerts(compared, threshold="low", keys=()):
    """One alert per degraded row whose severity reaches the threshold."""
    lines = [
        F.when(
            F.col(f"{m}_drop").isNotNull(),
            F.format_string(f"  {m}: %.4f\n", F.col(f"{m}_drop")),
        ).otherwise("")
        for m in WATCHED
    ]
    message = F.concat(
        F.lit(DEGRADED_TEXTS[0]), F.col("severity"),
        F.lit(DEGRADED_TEXTS[1]), *lines,
    )
    return compared.where(F.col("degraded") & _reaches(F.col("severity"), threshold)).select(
        *keys,
        F.lit(DEGRADED_TITLE).alias("title"),
        message.alias("message"),
        "severity",
        F.to_json(F.struct(*compared.columns)).alias("metadata"),
    )


def alert_log(log, order, n=1000):
    """The newest `n` alerts."""
    return keep_last(log, order, n)
