"""Long series cut into blocks must give what one window gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from odoscan.config import Settings, Track
from odoscan.operators import cleaning, entropy, features, ordering, quantiles, rules, series, smoothing
from odoscan.operators.ordering import BLOCK, SEQ, clear_layout, lay_out, lookup_join, running_totals, salted

WHOLE = Track()
CUT = Track(block_rows=64)


def same(a, b, key="rec_id"):
    a = a.toPandas().sort_values(key).reset_index(drop=True)
    b = b.toPandas().sort_values(key).reset_index(drop=True)[list(a.columns)]
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9, atol=1e-9)


def test_layout_numbers_and_cuts(fleet):
    laid = lay_out(fleet, CUT).toPandas()
    for _, rows in laid.groupby("Vehicle_ID"):
        rows = rows.sort_values(["timestamp", "rec_id"])
        assert list(rows[SEQ]) == list(range(len(rows)))
        assert list(rows[BLOCK]) == [i // 64 for i in range(len(rows))]
    assert BLOCK not in lay_out(fleet, WHOLE).columns


def chain(df, track):
    df = rules.stationary(series.steps(df, track))
    df = series.runs(df, track)
    df = series.acceleration(df, track)
    df = series.lagged(df, track, ["total_fuel", "Fuel_Diff"])
    df = series.rolling(df, track, ["total_fuel", "Fuel_Rate"], ["Fuel_Diff"])
    df = smoothing.macd(df, track, "total_fuel")
    return entropy.rolling_entropy(df, track, "total_fuel")


def test_blocks_equal_windows(fleet):
    cut = lay_out(fleet, CUT)
    assert cut.select(BLOCK).distinct().count() > 10
    same(clear_layout(chain(cut, CUT)), chain(fleet, WHOLE))


def test_interpolation_across_blocks(fleet):
    holes = fleet.withColumn("total_fuel", F.when(F.col("rec_id") % 3 == 0, F.col("total_fuel")))
    holes = holes.withColumn("total_fuel", F.when(F.col("rec_id").between(300, 900), None).otherwise(F.col("total_fuel")))
    columns = ["total_fuel", "speed_raw"]
    cut = cleaning.interpolate(lay_out(holes, CUT), CUT, columns)
    same(clear_layout(cut), cleaning.interpolate(holes, WHOLE, columns))
    rows = holes.toPandas().sort_values(["Vehicle_ID", "timestamp", "rec_id"])
    want = rows.groupby("Vehicle_ID")["total_fuel"].transform(lambda x: x.interpolate(limit_direction="both"))
    got = cut.toPandas().set_index("rec_id").loc[rows["rec_id"], "total_fuel"]
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), atol=1e-9)


@pytest.mark.parametrize("track", [WHOLE, CUT])
@pytest.mark.parametrize("nulls", [0.0, 0.4])
def test_weighted_means_match_pandas(spark, track, nulls):
    rng = np.random.default_rng(5)
    n = 2500
    rows = pd.DataFrame({"Vehicle_ID": np.where(np.arange(n) % 9 == 0, "B", "A"), "rec_id": np.arange(n)})
    rows["timestamp"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(rows["rec_id"], unit="min")
    rows["x"] = np.where(rng.random(n) < nulls, np.nan, rng.normal(size=n) * 50)
    rows.loc[rows["rec_id"].between(600, 1400), "x"] = np.nan if nulls else 1.0
    df = spark.createDataFrame(rows).withColumn("x", F.nanvl("x", F.lit(None)))
    spans = {"a5": 5, "a10": 10, "a30": 30}
    got = smoothing.weighted_means(lay_out(df, track), track, "x", spans).toPandas().set_index("rec_id").sort_index()
    for name, span in spans.items():
        want = rows.groupby("Vehicle_ID")["x"].transform(lambda s: s.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(got[name].to_numpy(), want.to_numpy(), atol=1e-9)


def test_running_totals_split_groups(fleet):
    sums = {"upto": F.col("total_fuel")}
    few = running_totals(fleet, ["Vehicle_ID"], ["timestamp", "rec_id"], sums, 50)
    same(few, running_totals(fleet, ["Vehicle_ID"], ["timestamp", "rec_id"], sums, 10**6))


@pytest.mark.parametrize("keys", [[], ["Vehicle_ID"]])
def test_quantiles_by_rank(fleet, keys):
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    small, big = Settings(), Settings(exact_group_rows=40)
    exact = quantiles.quantiles(fleet, ["total_fuel", "speed_raw"], probs, keys, small).toPandas()
    ranked = quantiles.quantiles(fleet, ["total_fuel", "speed_raw"], probs, keys, big).toPandas()
    if keys:
        exact, ranked = exact.sort_values(keys), ranked.sort_values(keys)
    for c in ("total_fuel", "speed_raw"):
        np.testing.assert_allclose(np.stack(ranked[c]), np.stack(exact[c]), atol=1e-12)


@pytest.mark.parametrize("limit", [0, 1000])
def test_lookup_join_keeps_every_row(fleet, limit):
    side = fleet.filter("driver_name is not null").groupBy("driver_name").agg(F.count("*").alias("n"))
    joined = lookup_join(fleet, side, "driver_name", "rec_id", limit).toPandas()
    assert len(joined) == fleet.count()
    assert joined["n"].isna().sum() == joined["driver_name"].isna().sum()
    sizes = joined.groupby("driver_name")["n"].agg(["count", "max"])
    assert (sizes["count"] == sizes["max"]).all()


def test_entropy_matches_numpy(fleet):
    rows = fleet.toPandas().sort_values(["Vehicle_ID", "timestamp", "rec_id"])
    rows.loc[rows.index[100:140], "total_fuel"] = 7.0

    def reference(x):
        hist, _ = np.histogram(x, bins="auto")
        p = hist[hist > 0] / hist.sum()
        return -np.sum(p * np.log2(p))

    windows = [rows["total_fuel"].to_numpy()[max(0, i - 19) : i + 1] for i in range(300)]
    got = entropy.histogram_entropy(pd.Series(windows))
    np.testing.assert_allclose(got, [reference(w) for w in windows], atol=1e-9)


def test_hot_keys_are_spread_by_their_count(spark):
    rows = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") < 3000, "hot").when(F.col("id") < 4000, "warm").when(F.col("id") < 4500, None).otherwise((F.col("id") % 700).cast("string")).alias("k")
    )
    side = rows.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spread, many = salted(rows, side, "k", "id", rows_per_task=100)
    sizes = {(r["k"], r["_salt"]): r["count"] for r in spread.filter("k is not null").groupBy("k", "_salt").count().collect()}
    assert max(sizes.values()) <= 150  # the largest task of a key, by its own number of salts
    assert sum(k == "hot" for k, _ in sizes) == 30 and sum(k == "warm" for k, _ in sizes) == 10
    assert many.filter("k = 'hot'").count() == 30 and many.filter("k = '5'").count() == 1
    joined = lookup_join(rows, side, "k", "id", 0, rows_per_task=100)
    want = {r["k"]: r["n"] for r in side.collect()}
    got = joined.collect()
    assert len(got) == 9000 and all(r["n"] == want.get(r["k"]) for r in got)


def test_running_totals_without_keys_are_sliced(spark):
    frame = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(5)
    got = running_totals(frame, [], ["id"], {"upto": F.col("v"), "at": F.lit(1).cast("long")}, 10_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    total = 0
    for r in got.orderBy("id").collect():
        total += r["v"]
        assert (r["upto"], r["at"]) == (total, r["id"] + 1)
    assert running_totals(frame.limit(0), [], ["id"], {"upto": F.col("v")}, 10).count() == 0


def test_many_quantiles_of_a_large_table_come_from_buckets(spark, monkeypatch):
    """The cut points of boosting: counting every distinct value of 136 columns took minutes."""
    rng = np.random.default_rng(5)
    n = 6000
    plain = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.where(rng.random(n) < 0.5, 0, rng.random(n)), "d": 5.0})
    text = ["a", "b", "if(a > 1, null, c) as c", "d", "cast(null as double) as nothing", "if(a > 1.5, double('nan'), c) as odd", "if(b = 1, -0.0D, 0.0D) as zero"]
    df = spark.createDataFrame(plain).selectExpr(*text)
    probs = [i / 255 for i in range(256)]
    base = df.withColumn(quantiles.ANY, F.lit(0))
    want = quantiles.of_counts(quantiles.value_counts(base, df.columns, [quantiles.ANY]), df.columns, probs, [quantiles.ANY]).first()

    def no(*_):
        raise AssertionError("every distinct value was shuffled")

    monkeypatch.setattr(quantiles, "value_counts", no)
    for placed, buckets in ((400, 50), (0, 50), (32_000, 4_000)):  # a poor sample and none give the same
        monkeypatch.setattr(quantiles, "PLACED", placed)
        monkeypatch.setattr(quantiles, "BUCKETS", buckets)
        got = quantiles.quantiles(df, df.columns, probs, settings=Settings(exact_group_rows=0)).first()
        for c in df.columns:
            assert (got[c] is None) == (want[c] is None)
            assert want[c] is None or np.array_equal(np.array(got[c]), np.array(want[c]), equal_nan=True), c
    assert quantiles.quantiles(df.limit(0), ["a"], probs, settings=Settings(exact_group_rows=-1)).first()["a"] is None


def test_feature_build_finds_the_longest_series_without_computing_its_rows(spark, fleet, monkeypatch):
    counted, largest = [], ordering.largest_group
    monkeypatch.setattr(ordering, "largest_group", lambda df, keys: counted.append(df) or largest(df, keys))
    raw = fleet.select("Vehicle_ID")
    features.build_features(fleet, sets=("temporal",), sized_by=raw)
    assert len(counted) == 1 and counted[0] is raw
