"""Blend, threshold, risk-table and alert queries on stand-in scores."""

from __future__ import annotations

from odoscan.operators import scoring
from odoscan.operators.cleaning import flag
from odoscan.operators.ordering import stage
from odoscan.plans.registry import query, r, rounded
from odoscan.plans.sql import RULES, SCORED
from odoscan.plans.views import profiled, scored, telemetry
from odoscan.operators import rules
from pyspark.sql import functions as F


def predicted(spark, sf_dir):
    return scoring.threshold_predictions(scored(spark, sf_dir))


@query(
    "score_blend",
    f"""WITH {SCORED}, b AS (SELECT rec_id, 0.5::DOUBLE * "Ensemble_Score" + 0.5::DOUBLE * "Theft_Probability" AS s FROM scored)
SELECT rec_id, {r("s / (SELECT max(s) FROM b)", "Final_Score")} FROM b""",
)
def score_blend(spark, sf_dir):
    return rounded(scoring.blend_final(stage(scored(spark, sf_dir).select("rec_id", "Ensemble_Score", "Theft_Probability")))
        .select("rec_id", "Final_Score"))


_DETECTED = (
    RULES
    + """,
detected AS (
  SELECT *, CASE WHEN rec_id % 17 = 0 THEN -1 ELSE rec_id % 3 END AS "DBSCAN_Cluster",
    CAST(rec_id % 101 = 0 AS INTEGER) AS "IsoForest_Anomaly", CAST(rec_id % 4 = 1 AS INTEGER) AS "Is_Suspicious_Cluster",
    rec_id % 4 AS "KMeans_Cluster"
  FROM ruled),
blend AS (SELECT *, 0.3::DOUBLE * "Anomaly_Score" + 0.25::DOUBLE * CAST("DBSCAN_Cluster" = -1 AS INTEGER)
    + 0.25::DOUBLE * "IsoForest_Anomaly" + 0.2::DOUBLE * "Is_Suspicious_Cluster" AS s FROM detected),
ensemble AS (SELECT *, round(s / (SELECT max(s) FROM blend), 12) AS "Ensemble_Score" FROM blend),
cut AS (SELECT quantile_cont("Ensemble_Score", 0.95) AS q FROM ensemble),
called AS (SELECT *, CAST("Ensemble_Score" > q AS INTEGER) AS "Predicted_Anomaly" FROM ensemble, cut)"""
)


def _detected(spark, sf_dir):
    """Rule scores with stand-in detector outputs."""
    rid = F.col("rec_id")
    weighed = stage(rules.weighted_rules(profiled(spark, sf_dir)).select("rec_id", "Anomaly_Score"))
    return rules.over_maximum(weighed, "Anomaly_Score").withColumns(
        {
            "DBSCAN_Cluster": F.when(rid % 17 == 0, -1).otherwise(rid % 3),
            "IsoForest_Anomaly": flag(rid % 101 == 0),
            "Is_Suspicious_Cluster": flag(rid % 4 == 1),
            "KMeans_Cluster": rid % 4,
        }
    )


@query("detector_blend", f"""WITH {_DETECTED} SELECT rec_id, {r('"Ensemble_Score"', "Ensemble_Score")}, "Predicted_Anomaly" FROM called""")
def detector_blend(spark, sf_dir):
    return rounded(scoring.blend_detectors(_detected(spark, sf_dir)).select("rec_id", "Ensemble_Score", "Predicted_Anomaly"))


@query(
    "detector_counts",
    f"""WITH {_DETECTED}, c AS (
  SELECT 'dbscan' AS detector, count(*) FILTER ("DBSCAN_Cluster" = -1) AS n_flagged, count(*) AS total,
    count(DISTINCT CASE WHEN "DBSCAN_Cluster" <> -1 THEN "DBSCAN_Cluster" END) AS n_clusters FROM called UNION ALL
  SELECT 'isolation_forest', sum("IsoForest_Anomaly"), count(*), NULL FROM called UNION ALL
  SELECT 'kmeans', sum("Is_Suspicious_Cluster"), count(*), count(DISTINCT "KMeans_Cluster") FROM called UNION ALL
  SELECT 'ensemble', sum("Predicted_Anomaly"), count(*), NULL FROM called)
SELECT detector, CAST(n_flagged AS BIGINT) AS n_flagged, {r("n_flagged / total", "flagged_rate")}, CAST(n_clusters AS BIGINT) AS n_clusters FROM c""",
)
def detector_counts(spark, sf_dir):
    return rounded(scoring.detector_counts(scoring.blend_detectors(_detected(spark, sf_dir))))


_PREDICTIONS = ["Prediction_conservative", "Prediction_balanced", "Prediction_aggressive", "Final_Prediction"]


@query("threshold_preds", f"""WITH {SCORED} SELECT rec_id, {", ".join(f'"{c}"' for c in _PREDICTIONS)} FROM predicted""")
def threshold_preds(spark, sf_dir):
    return predicted(spark, sf_dir).select("rec_id", *_PREDICTIONS)


@query(
    "prediction_counts",
    f"""WITH {SCORED} SELECT name, threshold, CAST(n AS BIGINT) AS n_predictions, {r("n / total", "prediction_rate")} FROM (
  SELECT 'conservative' AS name, 0.8::DOUBLE AS threshold, sum("Prediction_conservative") AS n, count(*) AS total FROM predicted UNION ALL
  SELECT 'balanced', 0.6, sum("Prediction_balanced"), count(*) FROM predicted UNION ALL
  SELECT 'aggressive', 0.4, sum("Prediction_aggressive"), count(*) FROM predicted)""",
)
def prediction_counts(spark, sf_dir):
    return rounded(scoring.prediction_counts(predicted(spark, sf_dir)))


def _risk_sql(key: str) -> str:
    return f"""WITH {SCORED} SELECT "{key}", count(*) AS "Final_Score_count", {r('avg("Final_Score")', "Final_Score_mean", 9)},
  CAST(sum("Final_Prediction") AS BIGINT) AS "Final_Prediction_sum" FROM predicted
WHERE "Final_Score" > 0.8 AND "{key}" IS NOT NULL GROUP BY "{key}" """


@query("risk_by_driver", _risk_sql("driver_name"))
def risk_by_driver(spark, sf_dir):
    return rounded(scoring.high_risk_by(predicted(spark, sf_dir), "driver_name"), 9)


@query("risk_by_place", _risk_sql("location"))
def risk_by_place(spark, sf_dir):
    return rounded(scoring.high_risk_by(predicted(spark, sf_dir), "location"), 9)


@query("risk_by_hour", _risk_sql("Hour"))
def risk_by_hour(spark, sf_dir):
    return rounded(scoring.high_risk_by(predicted(spark, sf_dir), "Hour"), 9)


@query(
    "score_stats",
    f"""WITH {SCORED} SELECT {r('avg("Final_Score")', "mean")}, {r('stddev_samp("Final_Score")', "std")},
  {r('min("Final_Score")', "min")}, {r('max("Final_Score")', "max")}, {", ".join(
        r(f'quantile_cont("Final_Score", {p})', f"q{int(round(p * 100))}") for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    )} FROM scored""",
)
def score_stats(spark, sf_dir):
    return rounded(scoring.score_stats(stage(scored(spark, sf_dir).select("Final_Score"))))


@query(
    "run_summary",
    f"""WITH {SCORED} SELECT count(*) AS total_records, CAST(sum("Final_Prediction") AS BIGINT) AS total_predictions,
  {r('sum("Final_Prediction") / count(*)', "detection_rate")}, count(*) FILTER ("Final_Score" > 0.8) AS high_risk_count,
  {r('avg("Final_Score")', "mean")}, {r('stddev_samp("Final_Score")', "std")}, {r('min("Final_Score")', "min")},
  {r('max("Final_Score")', "max")}, {r('quantile_cont("Final_Score", 0.5)', "median")} FROM predicted""",
)
def run_summary(spark, sf_dir):
    return rounded(scoring.summary(stage(predicted(spark, sf_dir).select("Final_Score", "Final_Prediction"))))


@query(
    "alert_priority",
    f"""WITH {SCORED}, a AS (SELECT * FROM predicted WHERE "Final_Prediction" = 1),
p AS (SELECT *, 0.3::DOUBLE * "Final_Score" + 0.3::DOUBLE * (abs("Fuel_Diff") / (SELECT max(abs("Fuel_Diff")) FROM a))
  + 0.2::DOUBLE * "Is_NightTime" + 0.2::DOUBLE * "Is_Stationary" AS s FROM a),
q AS (SELECT quantile_cont(s, 0.33) AS lo, quantile_cont(s, 0.67) AS hi FROM p)
SELECT rec_id, "timestamp", "Vehicle_ID", driver_name, location, total_fuel, {r('"Fuel_Diff"', "Fuel_Diff")}, {r('"Final_Score"', "Final_Score")},
  {r("s", "Priority_Score")}, CASE WHEN s IS NULL THEN NULL WHEN s <= lo THEN 'Low' WHEN s <= hi THEN 'Medium' ELSE 'High' END AS "Priority"
FROM p, q""",
)
def alert_priority(spark, sf_dir):
    alerts = scoring.alert_priority(stage(predicted(spark, sf_dir)))
    return alerts.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("Fuel_Diff", "Final_Score", "Priority_Score")})


@query(
    "risk_band",
    f"""WITH {SCORED} SELECT rec_id, CASE WHEN "Theft_Probability" >= 0.8 THEN 'High' WHEN "Theft_Probability" >= 0.5 THEN 'Medium'
  WHEN "Theft_Probability" >= 0.3 THEN 'Low' ELSE 'Very Low' END AS "Theft_Risk" FROM scored""",
)
def risk_band(spark, sf_dir):
    return scoring.risk_band(scored(spark, sf_dir)).select("rec_id", "Theft_Risk")


@query(
    "value_counts",
    f"""WITH {SCORED} SELECT location, count(*) AS n, {r("count(*) / (SELECT count(*) FROM scored)", "share")}
FROM scored WHERE location IS NOT NULL GROUP BY location""",
)
def value_counts(spark, sf_dir):
    return rounded(scoring.value_counts(telemetry(spark, sf_dir), "location"))


@query(
    "flagged_output",
    f"""WITH {SCORED} SELECT "timestamp", "Vehicle_ID", driver_name, location, total_fuel, {r('"Fuel_Diff"', "Fuel_Diff")}, "Final_Prediction"
FROM predicted WHERE "Final_Prediction" = 1""",
)
def flagged_output(spark, sf_dir):
    """The flagged rows, projected to the columns a reader needs."""
    rows = predicted(spark, sf_dir).filter("Final_Prediction = 1")
    kept = rows.select("timestamp", "Vehicle_ID", "driver_name", "location", "total_fuel", "Fuel_Diff", "Final_Prediction")
    return kept.withColumn("Fuel_Diff", F.round("Fuel_Diff", 6) + F.lit(0.0))
