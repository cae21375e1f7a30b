"""Blended scores, threshold predictions, alert ranking and risk tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings
from odoscan.operators.cleaning import flag
from odoscan.operators.quantiles import quantiles
from odoscan.operators.rules import over_maximum

# Blend weights, score thresholds, alert weights.
DETECTOR_WEIGHTS = {"rules": 0.3, "noise": 0.25, "isolation": 0.25, "cluster": 0.2}
THRESHOLDS = {"conservative": 0.8, "balanced": 0.6, "aggressive": 0.4}
HIGH_RISK = 0.8
ALERT_WEIGHTS = {"score": 0.3, "loss": 0.3, "night": 0.2, "still": 0.2}
SCORE_QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def _weighted(parts: Sequence[Column]) -> Column:
    return sum(parts, F.lit(0.0))


def blend_detectors(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Unsupervised score from the rules and detectors present; flagged above its 95% quantile.

    Detectors: ``Anomaly_Score``, noise label -1 in ``DBSCAN_Cluster``,
    ``IsoForest_Anomaly`` and ``Is_Suspicious_Cluster`` (left out under ``compat``).
    """
    sources = {
        "rules": ("Anomaly_Score", F.col("Anomaly_Score")),
        "noise": ("DBSCAN_Cluster", flag(F.col("DBSCAN_Cluster") == -1)),
        "isolation": ("IsoForest_Anomaly", F.col("IsoForest_Anomaly")),
        "cluster": ("Is_Suspicious_Cluster", F.col("Is_Suspicious_Cluster")),
    }
    if settings.compat:
        del sources["cluster"]
    parts = [value * F.lit(DETECTOR_WEIGHTS[name]) for name, (column, value) in sources.items() if column in df.columns]
    scored = over_maximum(df.withColumn("Ensemble_Score", _weighted(parts)), "Ensemble_Score")
    # Equal blends added up in another order stay equal.
    scored = scored.withColumn("Ensemble_Score", F.round("Ensemble_Score", 12))
    cut = quantiles(scored, ["Ensemble_Score"], [0.95], settings=settings).scalar()
    return scored.withColumn("Predicted_Anomaly", flag(F.col("Ensemble_Score") > cut[0]))


def blend_final(df: DataFrame) -> DataFrame:
    """Half unsupervised, half supervised score (or the one that exists), over its maximum."""
    both = {"Ensemble_Score", "Theft_Probability"} <= set(df.columns)
    parts = [F.col(c) * F.lit(0.5 if both else 1.0) for c in ("Ensemble_Score", "Theft_Probability") if c in df.columns]
    return over_maximum(df.withColumn("Final_Score", _weighted(parts)), "Final_Score")


def threshold_predictions(df: DataFrame) -> DataFrame:
    """One 0/1 column per threshold; the balanced one is final."""
    named = {f"Prediction_{name}": flag(F.col("Final_Score") > cut) for name, cut in THRESHOLDS.items()}
    return df.withColumns({**named, "Final_Prediction": named["Prediction_balanced"]})


def prediction_counts(df: DataFrame) -> DataFrame:
    """One row per threshold: cut, predictions and their rate."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(cut).alias("threshold"), F.col(f"Prediction_{name}").alias("n_predictions"))
            for name, cut in THRESHOLDS.items()
        ]
    )
    summed = df.agg(
        *[F.coalesce(F.sum(f"Prediction_{n}"), F.lit(0)).alias(f"Prediction_{n}") for n in THRESHOLDS],
        F.count(F.lit(1)).alias("total"),
    )
    return summed.select(F.explode(rows).alias("r"), "total").select(
        "r.name", "r.threshold", "r.n_predictions", F.try_divide("r.n_predictions", F.col("total")).alias("prediction_rate")
    )


def high_risk_by(df: DataFrame, key: str) -> DataFrame:
    """High-risk rows per driver, place or hour: count, mean score and final predictions."""
    risky = df.filter((F.col("Final_Score") > HIGH_RISK) & F.col(key).isNotNull())
    return risky.groupBy(key).agg(
        F.count(F.lit(1)).alias("Final_Score_count"),
        F.avg("Final_Score").alias("Final_Score_mean"),
        F.sum("Final_Prediction").alias("Final_Prediction_sum"),
    )


def score_stats(df: DataFrame, settings: Settings = Settings(), score: str = "Final_Score") -> DataFrame:
    """One row: mean, deviation, extremes and six quantiles of the score."""
    found = quantiles(df, [score], SCORE_QUANTILES, settings=settings).scalar()
    stats = df.agg(
        F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max")
    )
    return stats.withColumns({f"q{int(round(p * 100))}": found[i] for i, p in enumerate(SCORE_QUANTILES)})


def summary(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: rows, final predictions, detection rate, high-risk rows, score statistics."""
    median = quantiles(df, ["Final_Score"], [0.5], settings=settings).scalar()[0]
    hits = F.coalesce(F.sum("Final_Prediction"), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        hits.alias("total_predictions"),
        F.try_divide(hits, F.count(F.lit(1))).alias("detection_rate"),
        F.count_if(F.col("Final_Score") > HIGH_RISK).alias("high_risk_count"),
        F.avg("Final_Score").alias("mean"),
        F.stddev_samp("Final_Score").alias("std"),
        F.min("Final_Score").alias("min"),
        F.max("Final_Score").alias("max"),
    ).withColumn("median", median)


def detector_counts(df: DataFrame) -> DataFrame:
    """One row per detector: flagged rows, their rate, and clusters without noise."""
    detectors = {
        "dbscan": ("DBSCAN_Cluster", F.col("DBSCAN_Cluster") == -1),
        "isolation_forest": ("IsoForest_Anomaly", F.col("IsoForest_Anomaly") == 1),
        "kmeans": ("Is_Suspicious_Cluster", F.col("Is_Suspicious_Cluster") == 1),
        "ensemble": ("Predicted_Anomaly", F.col("Predicted_Anomaly") == 1),
    }
    present = {name: hit for name, (column, hit) in detectors.items() if column in df.columns}
    clusters = {"dbscan": "DBSCAN_Cluster", "kmeans": "KMeans_Cluster"}
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(hit).alias(name) for name, hit in present.items()]
    aggs += [
        F.count_distinct(F.when(F.col(c) != -1, F.col(c))).alias(f"_clusters_{name}")
        for name, c in clusters.items()
        if name in present and c in df.columns
    ]
    counts = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("detector"),
            F.col(name).alias("n_flagged"),
            F.try_divide(F.col(name), F.col("rows")).alias("flagged_rate"),
            (F.col(f"_clusters_{name}") if f"_clusters_{name}" in counts.columns else F.lit(None).cast("long")).alias("n_clusters"),
        )
        for name in present
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def alert_priority(df: DataFrame, roles: Roles = Roles(), settings: Settings = Settings()) -> DataFrame:
    """Flagged rows, ranked: score, loss against the largest loss, night and standing."""
    alerts = df.filter(F.col("Final_Prediction") == 1)
    top = alerts.agg(F.max(F.abs("Fuel_Diff")).alias("top")).scalar()
    loss = F.when(top > 0, F.abs("Fuel_Diff") / top)
    parts = {
        "score": ("Final_Score", F.col("Final_Score")),
        "loss": ("Fuel_Diff", loss),
        "night": ("Is_NightTime", F.col("Is_NightTime")),
        "still": ("Is_Stationary", F.col("Is_Stationary")),
    }
    used = [value * F.lit(ALERT_WEIGHTS[n]) for n, (column, value) in parts.items() if column in df.columns]
    alerts = alerts.withColumn("Priority_Score", _weighted(used))
    alerts = priority_bands(alerts, settings)
    shown = [
        roles.record, roles.time, roles.entity, roles.actor, roles.place, roles.level,
        "Fuel_Diff", "Final_Score", "Priority_Score", "Priority",
    ]
    return alerts.select(*[c for c in shown if c in alerts.columns]).orderBy(F.desc("Priority_Score"), roles.record)


def priority_bands(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Low, Medium, High at the 33% and 67% quantiles, closed on the right; ties take the lowest band."""
    cuts = quantiles(df, ["Priority_Score"], [0.33, 0.67], settings=settings).scalar()
    band = F.when(F.col("Priority_Score") <= cuts[0], "Low").when(F.col("Priority_Score") <= cuts[1], "Medium")
    return df.withColumn("Priority", F.when(F.col("Priority_Score").isNotNull(), band.otherwise("High")))


def risk_band(df: DataFrame, probability: str = "Theft_Probability", name: str = "Theft_Risk") -> DataFrame:
    p = F.col(probability)
    return df.withColumn(name, F.when(p >= 0.8, "High").when(p >= 0.5, "Medium").when(p >= 0.3, "Low").otherwise("Very Low"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """One row per value: rows and share. Nulls are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)
