"""Folders, the feature build at both scales, and whole runs."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from odoscan.config import Roles, Settings
from odoscan.models import store
from odoscan.operators.features import build_features, catalogue_names
from odoscan.plans import prediction, training
from odoscan.plans.views import labelled, stepped
from odoscan.sources import folder, sinks

FEATURES = ["Fuel_Diff", "Time_Diff", "speed_raw", "Is_Stationary", "Is_NightTime", "Stationary_Duration"]


def test_feature_build_is_the_same_beyond_every_limit(fleet):
    small, names = build_features(fleet)
    large, _ = build_features(fleet, settings=Settings(block_rows=64, broadcast_rows=0, exact_group_rows=100))
    assert {k: len(v) for k, v in names.items()} == {"temporal": 24, "statistical": 76, "behavioral": 28, "anomaly": 7}
    assert len(catalogue_names(names)) == 135
    a = small.toPandas().sort_values("rec_id").reset_index(drop=True)
    b = large.toPandas().sort_values("rec_id").reset_index(drop=True)[list(a.columns)]
    pd.testing.assert_frame_equal(a, b, rtol=1e-7, atol=1e-7)


def test_feature_sets_can_be_chosen(fleet):
    built, names = build_features(fleet.drop("driver_name"), sets=["temporal"], settings=Settings(compat=True))
    assert set(names) == {"temporal", "anomaly"} and "Location_Risk_Score" not in built.columns
    with pytest.raises(ValueError):
        build_features(fleet, sets=["spatial"])


@pytest.fixture
def csv_folder(tmp_path):
    (tmp_path / "ABC_2024.csv").write_text(
        'Tiempo, Tanque total ,Velocidad,Driver\n2024-01-01 00:00:00,10.5,0,Ann\n2024-01-01 00:10:00,-----,12,"O, Bo"\nbad,1,1,Ann\n'
    )
    (tmp_path / "DEF.csv").write_text('Tiempo,Tanque Total,Tanque total,"Ubicación\nzona"\n2024-01-02 00:00:00,,7,Depot\n')
    (tmp_path / "EMPTY.csv").write_text("")
    (tmp_path / "BROKEN.csv").write_bytes(b"\xff\xfe\xfa\n1\n")
    (tmp_path / "other.txt").write_text("x")
    return str(tmp_path)


def test_folder_union(spark, csv_folder):
    df, failed = folder.load_folder(spark, csv_folder)
    assert [f.rsplit("/", 1)[1] for f in failed] == ["BROKEN.csv"]
    rows = {(r["Vehicle_ID"], str(r["timestamp"])): r for r in df.collect()}
    assert len(rows) == 3
    first = rows["ABC", "2024-01-01 00:00:00"]
    assert first["total_fuel"] == "10.5" and first["Source_File"].endswith("ABC_2024.csv")
    second = rows["ABC", "2024-01-01 00:10:00"]
    assert second["total_fuel"] is None and second["driver_name"] == "O, Bo"
    # two columns of one name: the first is kept, null or not
    assert rows["DEF", "2024-01-02 00:00:00"]["total_fuel"] is None
    assert rows["DEF", "2024-01-02 00:00:00"]["Ubicación zona"] == "Depot"
    assert len({r["rec_id"] for r in rows.values()}) == 3


def test_folder_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        folder.load_folder(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        folder.load_folder(spark, str(tmp_path))


def test_round_trips(spark, fleet, tmp_path):
    for name in ("t.csv", "t.parquet"):
        path = sinks.write_table(fleet, f"{tmp_path}/{name}")
        assert folder.read_table(spark, path).count() == fleet.count()
    parts = sinks.write_table(fleet, f"{tmp_path}/by.parquet", partition_by=["Vehicle_ID"])
    assert {r[0] for r in spark.read.parquet(parts).select("Vehicle_ID").distinct().collect()} == {"V1", "V2", "V3"}
    none = sinks.write_predictions(fleet.withColumn("Predicted_Theft", F.lit(0)), str(tmp_path), "none.parquet")
    assert len(none) == 1
    some = sinks.write_predictions(fleet.withColumn("Predicted_Theft", F.col("rec_id") % 2), str(tmp_path), "some.csv")
    assert folder.read_table(spark, some[1]).count() * 2 == fleet.count()
    sinks.write_processed(fleet, str(tmp_path))
    back, _ = folder.load_folder(spark, str(tmp_path / "t.parquet"), "*.parquet")
    assert back.count() == fleet.count()
    with pytest.raises(ValueError):
        sinks.write_table(fleet, "x.xlsx")


def test_whole_run_and_prediction(spark, sf, tmp_path):
    rows = labelled(stepped(spark, sf)).select(
        "rec_id", "Vehicle_ID", "timestamp", "total_fuel", "speed_raw", "driver_name", "location", "Stationary_drain"
    )
    settings = Settings(max_clusters=3, restarts=1, trees=5, boosting_rounds=3, network_rounds=20, folds=2)
    out = str(tmp_path)
    results = training.run(rows, settings=settings, features=FEATURES, output=out, models=["logistic_regression", "random_forest", "boosted_leaves", "neural_network"])
    summary = results["summary"].first()
    assert summary["total_records"] == results["predictions"].count() == rows.count()
    assert results["models"].count() == 4 and results["models"].agg(F.max("f1")).first()[0] > 0.5
    assert 0 <= summary["min"] and summary["max"] == pytest.approx(1.0)
    assert results["prediction_counts"].count() == 3 and results["detectors"].count() == 4
    alerts = results["alerts"].collect()
    assert [a["Priority_Score"] for a in alerts] == sorted((a["Priority_Score"] for a in alerts), reverse=True)
    assert spark.read.option("header", True).csv(f"{out}/final_predictions.csv").count() == rows.count()

    model = store.load_best(spark, f"{out}/models")
    assert store.model_features(model) == FEATURES
    scored = prediction.predict(model, rows, settings=settings, output=out, name="thefts.csv")
    assert scored.count() == rows.count() and scored.filter("Theft_Risk is null").count() == 0
    assert spark.read.option("header", True).csv(f"{out}/all_thefts.csv").count() == rows.count()
    # a feature that the new data lacks counts as zero
    bare = prediction.score_rows(model, spark.range(5).select(F.col("id").alias("rec_id")), Roles())
    assert bare.count() == 5
    featured = spark.read.parquet(f"{out}/featured.parquet")
    ranked = prediction.compare(spark, f"{out}/models", featured).collect()
    assert ranked[0]["f1"] >= ranked[1]["f1"]

    # per-vehicle files that carry the label
    sinks.write_entity_files(rows, f"{out}/new")
    judged = prediction.evaluate_folder(spark, f"{out}/models", f"{out}/new", settings=settings)
    cells = {(r["label"], r["prediction"]): r["n"] for r in judged["confusion"].collect()}
    scored = judged["predictions"].select("Stationary_drain", "Predicted_Theft").collect()
    assert sum(cells.values()) == len(scored) > 0
    hits = sum(r["Stationary_drain"] == r["Predicted_Theft"] for r in scored)
    found = judged["metrics"].first()
    assert found["accuracy"] == pytest.approx(hits / len(scored)) and found["f1"] > 0.5
    assert {r["class"]: r["support"] for r in judged["report"].collect()} == {k: sum(n for (y, _), n in cells.items() if y == k) for k in (0, 1)}


def test_run_without_labels(spark, sf):
    rows = stepped(spark, sf).select("rec_id", "Vehicle_ID", "timestamp", "total_fuel", "speed_raw")
    results = training.run(rows, settings=Settings(max_clusters=3, restarts=1, trees=5), features=["Fuel_Diff", "speed_raw"])
    assert "models" not in results and results["summary"].first()["max"] == pytest.approx(1.0)


def test_package_travels(spark, tmp_path):
    import zipfile

    from odoscan.session import ship_package

    names = zipfile.ZipFile(ship_package(spark)).namelist()
    assert "odoscan/session.py" in names and "odoscan/sources/files.py" in names
