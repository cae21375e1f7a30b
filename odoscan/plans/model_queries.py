"""Scaling, split, metric, cluster, outlier and classifier queries."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from odoscan.config import Settings
from odoscan.models import classifiers, clusters, components, density, isolation, metrics, neighbours, sampling, scaling, store, unsupervised
from odoscan.operators import rules, shaping
from odoscan.operators.features import build_features
from odoscan.operators.ordering import shared_folder, stage
from odoscan.plans import prediction
from odoscan.plans.registry import query, r, rounded
from odoscan.plans.sql import FEATURED, RULES, SCORED, STEPS
from odoscan.plans.views import featured, labelled, profiled, scored, stepped, table, telemetry, telemetry_raw, uncleaned

_SCALED = ["total_fuel", "Fuel_Diff", "Time_Since_Refuel", "Is_Stationary", "IsWeekend"]


@query(
    "robust_scale",
    f"""WITH {FEATURED}, f AS (SELECT *, CAST(isodow("timestamp") >= 6 AS INTEGER) AS "IsWeekend" FROM featured)
SELECT rec_id, {", ".join(r(f'''(CAST("{c}" AS DOUBLE) - (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.5) FROM f))
  / (SELECT CASE WHEN quantile_cont(CAST("{c}" AS DOUBLE), 0.75) = quantile_cont(CAST("{c}" AS DOUBLE), 0.25) THEN 1
     ELSE quantile_cont(CAST("{c}" AS DOUBLE), 0.75) - quantile_cont(CAST("{c}" AS DOUBLE), 0.25) END FROM f)''', c) for c in _SCALED)} FROM f""",
)
def robust_scale(spark, sf_dir):
    rows = scaling.robust_scale(featured(spark, sf_dir).select("rec_id", *_SCALED), _SCALED)
    return rounded(rows)


def _draw_sql(key: str, seed: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 13))::UBIGINT AS DOUBLE) / 4503599627370496.0"


_LABELLED = (
    SCORED
    + """,
labelled AS (SELECT *, CAST(coalesce(speed_raw = 0 AND "Fuel_Diff" < -40, false) AS INTEGER) AS "Stationary_drain" FROM predicted),
noisy AS (SELECT * REPLACE (CASE WHEN rec_id % 13 = 0 THEN 1 - "Stationary_drain" ELSE "Stationary_drain" END AS "Stationary_drain") FROM labelled)"""
)


@query(
    "split_strat",
    f"""WITH {_LABELLED}, d AS (SELECT rec_id, "Stationary_drain", {_draw_sql("rec_id", "42")} AS u FROM labelled),
q AS (SELECT "Stationary_drain", quantile_cont(u, 0.2) AS cut FROM d GROUP BY ALL)
SELECT rec_id, "Stationary_drain", CAST(u <= cut AS INTEGER) AS is_test FROM d JOIN q USING ("Stationary_drain")""",
)
def split_strat(spark, sf_dir):
    rows = stage(labelled(stepped(spark, sf_dir)).select("rec_id", "Stationary_drain"))
    return sampling.split(rows)


@query(
    "fold_strat",
    f"""WITH {_LABELLED}, d AS (SELECT rec_id, "Stationary_drain", {_draw_sql("rec_id", "42-fold")} AS u FROM labelled),
q AS (SELECT "Stationary_drain", quantile_cont(u, 0.2) AS a, quantile_cont(u, 0.4) AS b, quantile_cont(u, 0.6) AS c, quantile_cont(u, 0.8) AS e FROM d GROUP BY ALL)
SELECT rec_id, CAST(u > a AS INTEGER) + CAST(u > b AS INTEGER) + CAST(u > c AS INTEGER) + CAST(u > e AS INTEGER) AS fold
FROM d JOIN q USING ("Stationary_drain")""",
)
def fold_strat(spark, sf_dir):
    rows = stage(labelled(stepped(spark, sf_dir)).select("rec_id", "Stationary_drain"))
    return sampling.folds(rows).select("rec_id", "fold")


@query(
    "undersample",
    f"""WITH {_LABELLED}, d AS (SELECT rec_id, "Stationary_drain", {_draw_sql("rec_id", "42-under")} AS u FROM labelled),
n AS (SELECT min(c) AS least FROM (SELECT count(*) AS c FROM d GROUP BY "Stationary_drain"))
SELECT rec_id, "Stationary_drain" FROM d, n QUALIFY row_number() OVER (PARTITION BY "Stationary_drain" ORDER BY u) <= least""",
)
def undersample(spark, sf_dir):
    return sampling.undersample(stage(labelled(stepped(spark, sf_dir)).select("rec_id", "Stationary_drain")))


@query(
    "class_weights",
    f"""WITH {_LABELLED}, c AS (SELECT "Stationary_drain", count(*) AS n FROM labelled GROUP BY ALL)
SELECT "Stationary_drain", n, {r("(SELECT sum(n) FROM c) / (2.0 * n)", "weight")} FROM c""",
)
def class_weights(spark, sf_dir):
    rows = stage(labelled(stepped(spark, sf_dir)).select("Stationary_drain"))
    weighted = sampling.class_weights(rows, "Stationary_drain")
    return rounded(weighted.groupBy("Stationary_drain", "weight").agg(F.count(F.lit(1)).alias("n")))


def _judged(spark, sf_dir):
    """Noisy labels against the stand-in prediction and score."""
    rows = labelled(scored(spark, sf_dir), noisy=True).select("rec_id", "total_fuel", "Final_Score", "Is_Stationary", "Fuel_Diff", "Stationary_drain")
    call = (F.col("Final_Score") > 0.6) | ((F.col("Is_Stationary") == 1) & (F.col("Fuel_Diff") < -60))
    return stage(rows.withColumn("Final_Prediction", F.coalesce(call, F.lit(False)).cast("int")))


_JUDGED = (
    _LABELLED
    + """,
judged AS (SELECT * REPLACE (CAST(coalesce("Final_Score" > 0.6 OR ("Is_Stationary" = 1 AND "Fuel_Diff" < -60), false) AS INTEGER) AS "Final_Prediction") FROM noisy)"""
)

_AUC = """(SELECT sum(CASE WHEN "Stationary_drain" = 1 THEN rk END) FROM ranked)"""


@query(
    "metrics",
    f"""WITH {_JUDGED}, ranked AS (SELECT "Stationary_drain", rank() OVER (ORDER BY "Final_Score")
    + (count(*) OVER (PARTITION BY "Final_Score") - 1) / 2.0 AS rk FROM judged),
c AS (SELECT CAST(count(*) FILTER ("Stationary_drain" = 1 AND "Final_Prediction" = 1) AS DOUBLE) AS tp,
  count(*) FILTER ("Stationary_drain" = 0 AND "Final_Prediction" = 1) AS fp, count(*) FILTER ("Stationary_drain" = 1 AND "Final_Prediction" = 0) AS fn,
  count(*) AS n, CAST(count(*) FILTER ("Stationary_drain" = 1) AS DOUBLE) AS p, CAST(count(*) FILTER ("Stationary_drain" = 0) AS DOUBLE) AS q FROM judged)
SELECT {r("(n - fp - fn) / n", "accuracy")}, {r("tp / (tp + fp)", "precision")}, {r("tp / (tp + fn)", "recall")},
  {r("2 * tp / (2 * tp + fp + fn)", "f1")}, {r(f"({_AUC} - p * (p + 1) / 2) / (p * q)", "roc_auc")} FROM c""",
)
def model_metrics(spark, sf_dir):
    return rounded(metrics.metrics(_judged(spark, sf_dir), "Stationary_drain", "Final_Prediction", "Final_Score"))


@query(
    "auc",
    f"""WITH {_JUDGED}, ranked AS (SELECT "Stationary_drain", rank() OVER (ORDER BY total_fuel)
    + (count(*) OVER (PARTITION BY total_fuel) - 1) / 2.0 AS rk FROM judged),
c AS (SELECT CAST(sum("Stationary_drain") AS DOUBLE) AS p, CAST(sum(1 - "Stationary_drain") AS DOUBLE) AS q FROM judged)
SELECT {r(f"({_AUC} - p * (p + 1) / 2) / (p * q)", "roc_auc")} FROM c""",
)
def auc(spark, sf_dir):
    return rounded(metrics.auc(_judged(spark, sf_dir), "Stationary_drain", "total_fuel"))


@query(
    "confusion",
    f"""WITH {_JUDGED} SELECT "Stationary_drain" AS label, "Final_Prediction" AS prediction, count(*) AS n FROM judged GROUP BY ALL""",
)
def confusion(spark, sf_dir):
    return metrics.confusion(_judged(spark, sf_dir), "Stationary_drain", "Final_Prediction")


@query(
    "class_report",
    f"""WITH {_JUDGED}, c AS (SELECT k AS "class", CAST(count(*) FILTER ("Stationary_drain" = k AND "Final_Prediction" = k) AS DOUBLE) AS hit,
  count(*) FILTER ("Stationary_drain" = k) AS support, count(*) FILTER ("Final_Prediction" = k) AS called
  FROM judged, (VALUES (0), (1)) v(k) GROUP BY k)
SELECT "class", {r("hit / called", "precision")}, {r("hit / support", "recall")}, {r("2 * hit / (support + called)", "f1")}, support FROM c""",
)
def class_report(spark, sf_dir):
    return rounded(metrics.class_report(_judged(spark, sf_dir), "Stationary_drain", "Final_Prediction"))


_THREE = [("conservative", 0.8), ("balanced", 0.6), ("aggressive", 0.4)]


@query(
    "model_rank",
    f"""WITH {_JUDGED}, m AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS model, 2.0 * count(*) FILTER ("Stationary_drain" = 1 AND "Final_Score" > {t})
  / (count(*) FILTER ("Stationary_drain" = 1) + count(*) FILTER ("Final_Score" > {t})) AS f FROM judged"""
        for n, t in _THREE
    )
    + f""") SELECT model, {r("f", "f1")}, CAST(f >= 0.99 AS INTEGER) AS suspicious FROM m""",
)
def model_rank(spark, sf_dir):
    """The three thresholds as competing models."""
    rows = _judged(spark, sf_dir)
    parts = [
        metrics.metrics(rows.withColumn("call", (F.col("Final_Score") > cut).cast("int")), "Stationary_drain", "call").withColumn("model", F.lit(name))
        for name, cut in _THREE
    ]
    table_ = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(metrics.rank_models(table_).select("model", "f1", "suspicious"))


@query(
    "pca",
    f"""WITH {STEPS}, c AS (SELECT var_samp(total_fuel) AS a, var_samp(speed_raw) AS d, covar_samp(total_fuel, speed_raw) AS b FROM steps),
e AS (SELECT (a + d) / 2 + sqrt(power((a - d) / 2, 2) + b * b) AS big, a + d AS total FROM c)
SELECT component, {r("share", "explained")}, {r("upto", "cumulative")}, needed_for_90 FROM (
  SELECT CAST(1 AS INTEGER) AS component, big / total AS share, big / total AS upto, CAST(1 AS INTEGER) AS needed_for_90 FROM e UNION ALL
  SELECT 2, 1 - big / total, 1, CAST(big / total < 0.9 AS INTEGER) FROM e)""",
)
def pca(spark, sf_dir):
    rows = stage(telemetry(spark, sf_dir).select(F.array("total_fuel", "speed_raw").alias("v")))
    return rounded(components.explained(components.fit_pca(rows, "v", 2), spark))


def _embedded(spark, sf_dir):
    return stage(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rec_id"), F.col("embedding").cast("array<double>").alias("v")))


@query("pca_embeddings")
def pca_embeddings(spark, sf_dir):
    return components.explained(components.fit_pca(_embedded(spark, sf_dir), "v"), spark)


@query("kmeans_search")
def kmeans_search(spark, sf_dir):
    return spark.createDataFrame(clusters.search_k(_embedded(spark, sf_dir), "v"), "k int, silhouette double")


@query("kmeans")
def kmeans(spark, sf_dir):
    rows = _embedded(spark, sf_dir)
    labels, _ = clusters.cluster(rows, "v", clusters.best_k(clusters.search_k(rows, "v")))
    return labels.select("rec_id", clusters.CLUSTER)


@query(
    "cluster_profile",
    f"""WITH {RULES}, c AS (SELECT rec_id % 4 AS "KMeans_Cluster", count(*) AS size, avg("Fuel_Diff") AS m, min("Fuel_Diff") AS lo, avg("Anomaly_Score") AS s
  FROM ruled GROUP BY 1)
SELECT "KMeans_Cluster", size, {r("m", "Fuel_Diff_mean")}, {r("lo", "Fuel_Diff_min")}, {r("s", "Anomaly_Score_mean")},
  CAST(s > 0.3 OR m < -2 AS INTEGER) AS suspicious FROM c""",
)
def cluster_profile(spark, sf_dir):
    rows = rules.rule_score(profiled(spark, sf_dir)).withColumn(clusters.CLUSTER, F.col("rec_id") % 4)
    return rounded(clusters.cluster_profile(rows))


@query(
    "dbscan_line",
    f"""WITH {STEPS}, w AS (SELECT rec_id, total_fuel AS x,
  count(*) OVER (ORDER BY total_fuel RANGE BETWEEN 0.105 PRECEDING AND 0.105 FOLLOWING) >= 5 AS core FROM steps),
g AS (SELECT rec_id, x, sum(CASE WHEN x - before <= 0.105 THEN 0 ELSE 1 END) OVER (ORDER BY x, rec_id) AS island
  FROM (SELECT rec_id, x, lag(x) OVER (ORDER BY x, rec_id) AS before FROM w WHERE core)),
l AS (SELECT island, row_number() OVER (ORDER BY min(rec_id)) - 1 AS label FROM g GROUP BY island),
n AS (SELECT w.rec_id, min(label) OVER (ORDER BY w.x RANGE BETWEEN 0.105 PRECEDING AND 0.105 FOLLOWING) AS near, label
  FROM w LEFT JOIN g ON w.rec_id = g.rec_id LEFT JOIN l ON g.island = l.island)
SELECT rec_id, CAST(coalesce(label, near, -1) AS INTEGER) AS "DBSCAN_Cluster" FROM n""",
)
def dbscan_line(spark, sf_dir):
    """On one coordinate density clusters are islands, which SQL can find too."""
    rows = stage(telemetry(spark, sf_dir).select("rec_id", F.array("total_fuel").alias("v")))
    return density.dbscan(rows, "v", settings=replace(Settings(), eps=0.105)).select("rec_id", density.LABEL)


_PLANE = ["total_fuel", "Fuel_Diff", "Stationary_Duration"]


def _scaled_sql(columns) -> str:
    """Median-filled, robust-scaled columns of ``featured`` as x0, x1, ..."""
    filled = ", ".join(f"""coalesce("{c}", (SELECT quantile_cont("{c}", 0.5) FROM featured)) AS f{i}""" for i, c in enumerate(columns))
    scaled = ", ".join(
        f"(f{i} - (SELECT quantile_cont(f{i}, 0.5) FROM filled)) / (SELECT coalesce(nullif(quantile_cont(f{i}, 0.75) - quantile_cont(f{i}, 0.25), 0), 1) FROM filled) AS x{i}"
        for i in range(len(columns))
    )
    return f"filled AS (SELECT rec_id, {filled} FROM featured), scaled AS MATERIALIZED (SELECT rec_id, {scaled} FROM filled)"


@query(
    "dbscan",
    f"""WITH RECURSIVE {FEATURED}, {_scaled_sql(_PLANE)},
near AS MATERIALIZED (SELECT a.rec_id AS a, b.rec_id AS b FROM scaled a JOIN scaled b ON abs(a.x0 - b.x0) <= 0.0503 AND abs(a.x1 - b.x1) <= 0.0503
  AND power(a.x0 - b.x0, 2) + power(a.x1 - b.x1, 2) + power(a.x2 - b.x2, 2) <= 0.0503 * 0.0503),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
edge AS MATERIALIZED (SELECT a, b FROM near WHERE a <> b AND a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
grow(id, label) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT e.b, min(g.label) FROM grow g JOIN edge e ON e.a = g.id JOIN recurring.grow r ON r.id = e.b WHERE g.label < r.label GROUP BY e.b),
named AS (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS label FROM grow),
beside AS (SELECT n.a AS id, min(m.label) AS label FROM near n JOIN named m ON m.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a)
SELECT rec_id, CAST(coalesce(m.label, b.label, -1) AS INTEGER) AS "DBSCAN_Cluster"
FROM scaled LEFT JOIN named m ON m.id = rec_id LEFT JOIN beside b ON b.id = rec_id""",
)
def dbscan(spark, sf_dir):
    scaled = scaling.scaled_matrix(featured(spark, sf_dir).select("rec_id", *_PLANE), _PLANE)
    rows = stage(scaled.select("rec_id", F.array(*_PLANE).alias("v")))
    return density.dbscan(rows, "v", settings=replace(Settings(), eps=0.0503)).select("rec_id", density.LABEL)


def _built(spark, sf_dir):
    """Rows with all features, and the features' names."""
    built, _ = build_features(telemetry(spark, sf_dir), sized_by=uncleaned(spark, sf_dir))
    return built, shaping.feature_columns(built)


def _scaled_features(spark, sf_dir):
    built, names = _built(spark, sf_dir)
    return stage(built.select("rec_id", scaling.fit_preparation(built, names).as_array().alias("v")))


@query("dbscan_features")
def dbscan_features(spark, sf_dir):
    """All features at the default reach, where most rows are noise."""
    rows = _scaled_features(spark, sf_dir)
    return density.dbscan(rows, "v").select("rec_id", density.LABEL)


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    return isolation.isolation_forest(_scaled_features(spark, sf_dir), "v", keep_vector=False)


@query(
    "neighbours",
    f"""WITH {_LABELLED}, v AS (SELECT DISTINCT total_fuel AS a, "Fuel_Diff" AS b FROM labelled WHERE "Stationary_drain" = 1),
p AS (SELECT x.a, x.b, sqrt(power(x.a - y.a, 2) + power(x.b - y.b, 2)) AS d FROM v x JOIN v y ON x.a <> y.a OR x.b <> y.b),
k AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY d) AS "rank" FROM p)
SELECT {r("a", "total_fuel")}, {r("b", "Fuel_Diff")}, CAST("rank" AS INTEGER) AS "rank", {r("d", "distance")} FROM k WHERE "rank" <= 5""",
)
def nearest_neighbours(spark, sf_dir):
    """The five nearest other losses of every labelled loss."""
    rows = stage(labelled(stepped(spark, sf_dir)).filter("Stationary_drain = 1").select("rec_id", F.array("total_fuel", "Fuel_Diff").alias("v")))
    found = neighbours.nearest(rows, "v", 5).select("v", F.explode("neighbours").alias("n")).filter("n.rank > 0")
    return rounded(
        found.select(F.col("v")[0].alias("total_fuel"), F.col("v")[1].alias("Fuel_Diff"), F.col("n.rank").alias("rank"), F.col("n.distance").alias("distance"))
    )


@query(
    "smote",
    f"""WITH {_LABELLED}, c AS (SELECT "Stationary_drain", count(*) AS original FROM labelled GROUP BY ALL)
SELECT "Stationary_drain", original, (SELECT max(original) FROM c) - original AS synthetic FROM c""",
)
def smote(spark, sf_dir):
    """Rows and synthetic rows per class after balancing."""
    rows = stage(labelled(stepped(spark, sf_dir)))
    vectors = rows.select("rec_id", "Stationary_drain", F.array("total_fuel", F.coalesce("Fuel_Diff", F.lit(0.0)), "speed_raw").alias("v"))
    balanced = sampling.oversample(vectors, "v")
    return balanced.groupBy("Stationary_drain").agg(F.count("rec_id").alias("original"), F.count_if(F.col("rec_id").isNull()).alias("synthetic"))


def _training_rows(spark, sf_dir):
    built, names = _built(spark, sf_dir)
    return stage(labelled(built, noisy=True).select("rec_id", *names, "Stationary_drain")), names


def _trained(spark, sf_dir, names=None):
    """Classifiers on all features, trained anew, and the rows behind them."""
    rows, features = _training_rows(spark, sf_dir)
    return classifiers.train(rows, features, names=names), rows


@query("classifiers")
def compare_classifiers(spark, sf_dir):
    trained, _ = _trained(spark, sf_dir)
    return metrics.rank_models(trained.scores)


@query("cross_validate")
def cross_validate(spark, sf_dir):
    """The best classifier, over all folds."""
    trained, rows = _trained(spark, sf_dir)
    return classifiers.cross_validate(rows, trained.features, trained.best)


@query("importance")
def importance(spark, sf_dir):
    """Features by mean importance over the tree models."""
    trained, _ = _trained(spark, sf_dir, classifiers.TREES)
    return classifiers.mean_importance(classifiers.importance(trained.models, trained.features, spark), 10)


def _saved(spark, trained):
    return store.save_models(trained, f"{shared_folder(spark)}/models-{uuid.uuid4().hex}")


@query("predict_batch")
def predict_batch(spark, sf_dir):
    """Raw rows through cleaning, features and a model loaded from its saved form."""
    trained, _ = _trained(spark, sf_dir)
    return prediction.predict(store.load_best(spark, _saved(spark, trained)), telemetry_raw(spark, sf_dir))


@query("compare_models")
def compare_models(spark, sf_dir):
    """All saved models, loaded again, on all labelled rows."""
    trained, rows = _trained(spark, sf_dir)
    return prediction.compare(spark, _saved(spark, trained), rows)


@query("detectors")
def detectors(spark, sf_dir):
    """Every detector and the blended unsupervised score per row."""
    detected, _ = unsupervised.detect(*_built(spark, sf_dir))
    return detected.select(
        "rec_id", clusters.CLUSTER, "Is_Suspicious_Cluster", density.LABEL, "IsoForest_Score", "IsoForest_Anomaly", "Ensemble_Score", "Predicted_Anomaly"
    )
