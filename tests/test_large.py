"""What must not grow faster than the table: passes over it, shuffles, jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from odoscan.config import Settings
from odoscan.operators import quantiles, summaries


def test_feature_stats_pass_over_the_rows_once_for_counts(spark):
    frame = spark.range(400).select(F.col("id"), (F.col("id") % 7).alias("v"))
    stats = summaries.feature_stats(frame, ["id", "v"], Settings(exact_group_rows=50), digits=9)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # the moments; counts and quartiles read what was written
    got = {r["feature"]: r for r in stats.collect()}
    assert got["id"]["q25"] == 99.75 and got["id"]["unique_count"] == 400 and got["v"]["q75"] == 5.0 and got["v"]["unique_count"] == 7


def test_few_quantiles_of_a_large_table_shuffle_only_values_near_them(spark):
    rng = np.random.default_rng(6)
    n = 60_000
    rows = pd.DataFrame({"x": rng.normal(size=n), "same": 3.0, "ties": rng.integers(0, 4, n).astype(float), "holes": rng.random(n)})
    rows.loc[rng.random(n) < 0.3, "holes"] = np.nan
    frame = spark.createDataFrame(rows).repartition(6).withColumns({"holes": F.nanvl("holes", F.lit(None)), "none": F.lit(None).cast("double")})
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = quantiles._between(frame, frame.columns, probs).first()
    for c in rows:
        np.testing.assert_allclose(got[c], np.nanquantile(rows[c], probs), rtol=0, atol=1e-12)
    assert got["none"] is None


def test_quantiles_beside_what_is_not_a_number(spark):
    values = [1.0, 2.0, 2.0, float("inf"), float("nan"), float("nan"), None, -float("inf")]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 1 / 6, 0.5, 1.0]
    small = quantiles.quantiles(frame, ["x"], probs).first()[0]
    large = quantiles.quantiles(frame, ["x"], probs, settings=Settings(exact_group_rows=1)).first()[0]
    assert large == pytest.approx(small, nan_ok=True)


def test_kmeans_jobs_do_not_add_up_over_the_fits(spark):
    from odoscan.models import clusters

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(80, 3)) * 0.3 + c for c in ([0, 0, 0], [6, 6, 0], [0, 6, 6])] + [np.zeros((60, 3))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "rec_id long, v array<double>")
    sc = spark.sparkContext
    sc.setJobGroup("few", "k-means restarts")
    labelled, few = clusters.cluster(frame, "v", 3, Settings(restarts=2))
    sc.setJobGroup("many", "k-means restarts")
    _, many = clusters.cluster(frame, "v", 3, Settings(restarts=12))
    sc.setJobGroup("", "")
    jobs = [len(sc.statusTracker().getJobIdsForGroup(g)) for g in ("few", "many")]
    assert 0 < jobs[1] <= 2 * jobs[0]
    want = sum(((part - part.mean(axis=0)) ** 2).sum() for part in (np.concatenate([x[:80], x[240:]]), x[80:160], x[160:240]))
    assert many.cost == pytest.approx(want) and few.cost == pytest.approx(want)
    got = labelled.toPandas().set_index("rec_id")[clusters.CLUSTER].to_numpy()
    assert all(len(set(got[rows])) == 1 for rows in (np.r_[:80, 240:300], np.r_[80:160], np.r_[160:240]))
    same, _ = clusters.cluster(frame.limit(40).withColumn("v", F.array(F.lit(1.0), F.lit(2.0))), "v", 3, Settings(restarts=2))
    assert {r[clusters.CLUSTER] for r in same.collect()} == {0}


def test_damaged_files_do_not_deal_rows_by_file(spark, tmp_path):
    from odoscan.sources import folder

    spark.range(1000).withColumn("x", F.col("id") * 2).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    (tmp_path / "t.parquet" / "part-99999_damaged.parquet").write_bytes(b"PAR1 this is no footer PAR1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table were large
    try:
        rows, _ = folder.read_folder(spark, str(tmp_path / "t.parquet"), "*.parquet")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_distinct_values_are_counted_in_sorted_runs(spark, monkeypatch):
    """A row per value of every column was shuffled, 133 times the table."""
    from odoscan.operators import distinct

    monkeypatch.setattr(distinct, "RANGE_ROWS", 300)
    monkeypatch.setattr(distinct, "SORTED", 128)
    rng = np.random.default_rng(2)
    n = 4000
    x = np.round(rng.normal(size=n), 2)
    x[:3] = [0.0, -0.0, np.inf]
    rows = pd.DataFrame({"x": x, "k": rng.integers(-50, 900, n), "same": 1.5})
    frame = spark.createDataFrame(rows).repartition(5).selectExpr(
        "*", "if(k > 500, null, x) as holes", "if(k > 700, double('nan'), x) as odd", "k > 3 as flag", "cast(x as float) as half", "cast(null as int) as none", "cast(k as string) as text"
    )
    got = {r["column_name"]: r for r in summaries.column_summary(frame).collect()}
    every = frame.toPandas()
    for c in ("x", "k", "same", "flag", "half", "text"):
        want = len({str(v) for v in every[c]})  # as text, both zeros count
        assert (got[c]["distinct_values"], got[c]["nulls"], got[c]["rows"]) == (want, 0, n), c
    assert got["none"]["distinct_values"] == 0 and got["none"]["nulls"] == n
    known = every["k"] <= 500
    assert got["holes"]["nulls"] == (~known).sum() and got["holes"]["distinct_values"] == len({str(v) for v in every["x"][known]})
    assert got["odd"]["distinct_values"] == len({str(v) for v in every["x"][every["k"] <= 700]}) + 1
    assert summaries.column_summary(frame.limit(0)).count() == 0
    plan = summaries.column_summary(frame.drop("text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
    stats = {r["feature"]: r for r in summaries.feature_stats(frame, ["x", "k"], digits=9).collect()}
    assert stats["x"]["unique_count"] == len(set(x)) and stats["k"]["q25"] == np.quantile(rows["k"], 0.25)


def test_medians_and_filled_quartiles_come_from_the_same_scans(spark, monkeypatch):
    from odoscan.models import scaling

    rng = np.random.default_rng(9)
    n = 5001
    rows = pd.DataFrame({c: np.where(rng.random(n) < share, np.nan, rng.normal(size=n).round(d)) for c, share, d in (("a", 0.0, 3), ("b", 0.3, 8), ("c", 0.6, 8), ("d", 0.4, 0))})
    frame = spark.createDataFrame(rows).selectExpr(*[f"nanvl({c}, null) as {c}" for c in rows], "cast(null as double) as none", "1 as one").repartition(4)
    want = scaling.fit_preparation(frame, frame.columns)
    monkeypatch.setattr(scaling, "quantiles", lambda *_, **__: pytest.fail("scanned again"))
    for placed in (0, 200, 32_000):
        monkeypatch.setattr(quantiles, "PLACED", placed)
        got = scaling.fit_preparation(frame, frame.columns, Settings(exact_group_rows=0))
        for part in ("fill", "centre", "spread"):
            assert getattr(got, part) == pytest.approx(getattr(want, part), abs=1e-12), (placed, part)


def test_isolation_scores_are_computed_once(spark):
    """The quantile read scores of its own, and the result scored every row again."""
    from odoscan.models import isolation

    rng = np.random.default_rng(1)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 3)))], "rec_id long, v array<double>")
    out = isolation.isolation_forest(frame, "v", settings=Settings(trees=20), keep_vector=False)
    assert "EvalPython" not in out._jdf.queryExecution().optimizedPlan().toString() and out.columns == ["rec_id", "IsoForest_Score", "IsoForest_Anomaly"]
    assert out.agg(F.sum("IsoForest_Anomaly")).first()[0] == 5
