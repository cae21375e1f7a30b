"""Calendar, step, rolling, run and smoothing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from odoscan.functions import calendar as cal
from odoscan.operators import series, smoothing
from odoscan.operators.entropy import rolling_entropy
from odoscan.plans.registry import query, r, rounded
from odoscan.plans.sql import FEATURED, STEPS, TELEMETRY
from odoscan.plans.views import TRACK, featured, ordered, stepped, telemetry


def _q(name: str) -> str:
    return f'"{name}"'


@query(
    "night_loss_by_vehicle",
    f"""WITH {STEPS}
SELECT "Vehicle_ID", count(*) AS events, {r('sum(-"Fuel_Diff")', "lost")} FROM steps
WHERE "Is_Stationary" = 1 AND (extract(hour FROM "timestamp") >= 22 OR extract(hour FROM "timestamp") <= 5) AND "Fuel_Diff" < -2.5
GROUP BY "Vehicle_ID" """,
)
def night_loss_by_vehicle(spark, sf_dir):
    """Losses of standing vehicles at night, per vehicle: how many, and how much."""
    lost = cal.calendar(stepped(spark, sf_dir)).filter("Is_Stationary = 1 and Is_NightTime = 1 and Fuel_Diff < -2.5")
    return rounded(lost.groupBy("Vehicle_ID").agg(F.count(F.lit(1)).alias("events"), F.sum(-F.col("Fuel_Diff")).alias("lost")))


@query(
    "calendar",
    f"""WITH {TELEMETRY}, p AS (SELECT rec_id, CAST(extract(hour FROM "timestamp") AS INTEGER) AS h,
  CAST(isodow("timestamp") - 1 AS INTEGER) AS d, CAST(day("timestamp") AS INTEGER) AS "Day", CAST(month("timestamp") AS INTEGER) AS "Month" FROM telemetry)
SELECT rec_id, h AS "Hour", d AS "DayOfWeek", "Day", "Month", CAST(d IN (5, 6) AS INTEGER) AS "IsWeekend",
  CAST(h >= 22 OR h <= 5 AS INTEGER) AS "Is_NightTime",
  CASE WHEN h <= 6 THEN 'Night' WHEN h <= 12 THEN 'Morning' WHEN h <= 18 THEN 'Afternoon' ELSE 'Evening' END AS "TimeOfDay" FROM p""",
)
def calendar(spark, sf_dir):
    return cal.calendar(telemetry(spark, sf_dir)).select(
        "rec_id", "Hour", "DayOfWeek", "Day", "Month", "IsWeekend", "Is_NightTime", "TimeOfDay"
    )


_CYCLES = {"Hour": ("extract(hour FROM ts)", 24), "DayOfWeek": ("(isodow(ts) - 1)", 7), "Day": ("day(ts)", 31), "Month": ("month(ts)", 12)}


@query(
    "cyclical",
    "SELECT event_id, "
    + ", ".join(
        r(f"{fn}(2 * pi() * {part} / {period})", f"{name}_{fn.capitalize()}")
        for name, (part, period) in _CYCLES.items()
        for fn in ("sin", "cos")
    )
    + " FROM events",
)
def cyclical(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").alias("timestamp"))
    names = [f"{n}_{fn}" for n in _CYCLES for fn in ("Sin", "Cos")]
    return rounded(cal.cyclical(cal.calendar(events)).select("event_id", *names))


@query(
    "gap_category",
    f"""WITH {STEPS}
SELECT rec_id, CASE WHEN "Time_Diff" <= 0 THEN NULL WHEN "Time_Diff" <= 5 THEN 'Very_Short' WHEN "Time_Diff" <= 15 THEN 'Short'
  WHEN "Time_Diff" <= 30 THEN 'Medium' WHEN "Time_Diff" <= 60 THEN 'Long' WHEN "Time_Diff" > 60 THEN 'Very_Long' END AS "Time_Diff_Category"
FROM steps""",
)
def gap_category(spark, sf_dir):
    return cal.gap_category(stepped(spark, sf_dir)).select("rec_id", "Time_Diff_Category")


_STEPS = ["Time_Diff", "Fuel_Diff", "Fuel_Rate"]


@query("gap_diff_rate", f"""WITH {STEPS} SELECT rec_id, {", ".join(r(_q(c), c, 9) for c in _STEPS)} FROM steps""")
def gap_diff_rate(spark, sf_dir):
    return rounded(stepped(spark, sf_dir).select("rec_id", *_STEPS), 9)


@query(
    "acceleration",
    f"""WITH {STEPS}, a AS (SELECT rec_id, "Fuel_Rate" - lag("Fuel_Rate") OVER (PARTITION BY "Vehicle_ID" ORDER BY rn) AS a FROM steps)
SELECT rec_id, {r("a", "Fuel_Acceleration")}, CAST(coalesce(a < -0.1, false) AS INTEGER) AS "Is_Sharp_Deceleration" FROM a""",
)
def acceleration(spark, sf_dir):
    rows = series.acceleration(stepped(spark, sf_dir), TRACK)
    return rounded(rows.select("rec_id", "Fuel_Acceleration", "Is_Sharp_Deceleration"))


_LAGGED = ["total_fuel", "Fuel_Diff", "speed_raw"]


@query(
    "lags",
    f"""WITH {STEPS} SELECT rec_id, {", ".join(r(f'lag("{c}", {n}) OVER v', f"{c}_Lag_{n}") for n in (1, 2, 3) for c in _LAGGED)}
FROM steps WINDOW v AS (PARTITION BY "Vehicle_ID" ORDER BY rn)""",
)
def lags(spark, sf_dir):
    rows = series.lagged(stepped(spark, sf_dir), TRACK, _LAGGED)
    return rounded(rows.select("rec_id", *[f"{c}_Lag_{n}" for n in (1, 2, 3) for c in _LAGGED]))


@query("stationary_run", f"""WITH {FEATURED} SELECT rec_id, "Is_Stationary", {r(_q("Stationary_Duration"), "Stationary_Duration", 9)} FROM featured""")
def stationary_run(spark, sf_dir):
    rows = series.runs(stepped(spark, sf_dir), TRACK, parts=("stationary",))
    return rounded(rows.select("rec_id", "Is_Stationary", "Stationary_Duration"), 9)


@query("since_refuel", f"""WITH {FEATURED} SELECT rec_id, "Is_Refuel", {r(_q("Time_Since_Refuel"), "Time_Since_Refuel")} FROM featured""")
def since_refuel(spark, sf_dir):
    rows = series.runs(stepped(spark, sf_dir), TRACK, parts=("refuel",))
    return rounded(rows.select("rec_id", "Is_Refuel", "Time_Since_Refuel"))


@query(
    "loss_streak",
    f"""WITH {STEPS}, l AS (SELECT rec_id, "Vehicle_ID", rn, CAST(coalesce("Fuel_Diff" < 0, false) AS INTEGER) AS loss FROM steps),
g AS (SELECT *, sum(1 - loss) OVER (PARTITION BY "Vehicle_ID" ORDER BY rn) AS g FROM l)
SELECT rec_id, loss AS "Is_Fuel_Loss", CAST(sum(loss) OVER (PARTITION BY "Vehicle_ID", g ORDER BY rn) AS INTEGER) AS "Consecutive_Losses" FROM g""",
)
def loss_streak(spark, sf_dir):
    rows = series.runs(stepped(spark, sf_dir), TRACK, parts=("losses",))
    return rows.select("rec_id", "Is_Fuel_Loss", "Consecutive_Losses")


@query(
    "event_flags",
    f"""WITH {FEATURED} SELECT rec_id, "Is_Stationary", "Is_Refuel", "Is_Sudden_Drop", "Is_NightTime" FROM featured""",
)
def event_flags(spark, sf_dir):
    return featured(spark, sf_dir).select("rec_id", "Is_Stationary", "Is_Refuel", "Is_Sudden_Drop", "Is_NightTime")


_ROLLED = ["total_fuel", "Fuel_Diff", "Fuel_Rate", "speed_raw"]
_EXTREMES = ["total_fuel", "Fuel_Diff"]
_SIZES = (5, 10, 30)
_FRAMES = "WINDOW " + ", ".join(
    f'w{n} AS (PARTITION BY "Vehicle_ID" ORDER BY rn ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)' for n in _SIZES
)


def _rolled(fn: str, column: str, n: int) -> str:
    return f'{fn}("{column}") OVER w{n}'


@query(
    "rolling_mean_std",
    f"""WITH {STEPS} SELECT rec_id, {", ".join(
        r(_rolled(fn, c, n), f"{c}_Rolling_{name}_{n}") for n in _SIZES for c in _ROLLED for fn, name in (("avg", "Mean"), ("stddev_samp", "Std"))
    )} FROM steps {_FRAMES}""",
)
def rolling_mean_std(spark, sf_dir):
    rows = series.rolling(stepped(spark, sf_dir), TRACK, _ROLLED)
    return rounded(rows.select("rec_id", *[f"{c}_Rolling_{k}_{n}" for n in _SIZES for c in _ROLLED for k in ("Mean", "Std")]))


@query(
    "rolling_min_max",
    f"""WITH {STEPS} SELECT rec_id, {", ".join(
        r(_rolled(fn, c, n), f"{c}_Rolling_{fn.capitalize()}_{n}") for n in _SIZES for c in _EXTREMES for fn in ("min", "max")
    )} FROM steps {_FRAMES}""",
)
def rolling_min_max(spark, sf_dir):
    rows = series.rolling(stepped(spark, sf_dir), TRACK, [], _EXTREMES)
    return rounded(rows.select("rec_id", *[f"{c}_Rolling_{k}_{n}" for n in _SIZES for c in _EXTREMES for k in ("Min", "Max")]))


@query(
    "rolling_range",
    f"""WITH {STEPS} SELECT rec_id, {", ".join(
        r(f"max(total_fuel) OVER w{n} - min(total_fuel) OVER w{n}", f"Fuel_Range_{n}") for n in (10, 30)
    )} FROM steps {_FRAMES}""",
)
def rolling_range(spark, sf_dir):
    rows = series.rolling(ordered(spark, sf_dir), TRACK, [], ["total_fuel"], (10, 30))
    return rounded(series.rolling_range(rows, "total_fuel").select("rec_id", "Fuel_Range_10", "Fuel_Range_30"))


@query(
    "cv",
    f"""WITH {STEPS} SELECT rec_id, {", ".join(
        r(f'stddev_samp("{c}") OVER w{n} / (abs(avg("{c}") OVER w{n}) + 1e-6)', f"{c}_CV_{n}", 4) for c in ("total_fuel", "Fuel_Rate") for n in _SIZES
    )} FROM steps {_FRAMES}""",
)
def cv(spark, sf_dir):
    columns = ["total_fuel", "Fuel_Rate"]
    rows = series.variation(series.rolling(stepped(spark, sf_dir), TRACK, columns), columns)
    return rounded(rows.select("rec_id", *[f"{c}_CV_{n}" for c in columns for n in _SIZES]), 4)


def _ewma(span: int) -> str:
    a = f"(2.0::DOUBLE / {span + 1})"
    return f"list_reduce(xs, lambda y, x: (1 - {a}) * y + {a} * x)"


_SERIES = f'{TELEMETRY}, l AS (SELECT rec_id, list(total_fuel) OVER (PARTITION BY "Vehicle_ID" ORDER BY "timestamp", rec_id) AS xs FROM telemetry)'


@query("ewma", f"""WITH {_SERIES} SELECT rec_id, {", ".join(r(_ewma(n), f"Fuel_EWMA_{n}") for n in _SIZES)} FROM l""")
def ewma(spark, sf_dir):
    rows = smoothing.weighted_means(ordered(spark, sf_dir), TRACK, "total_fuel", {f"Fuel_EWMA_{n}": n for n in _SIZES})
    return rounded(rows.select("rec_id", *[f"Fuel_EWMA_{n}" for n in _SIZES]))


@query("macd", f"""WITH {_SERIES} SELECT rec_id, {r(f"{_ewma(12)} - {_ewma(26)}", "Fuel_MACD")} FROM l""")
def macd(spark, sf_dir):
    return rounded(smoothing.macd(ordered(spark, sf_dir), TRACK, "total_fuel").select("rec_id", "Fuel_MACD"))


_SCORED = ["total_fuel", "Fuel_Diff", "Fuel_Rate", "Stationary_Duration"]


def _z(column: str, over: str) -> str:
    c = f'"{column}"'
    mean = f"avg({c}) OVER {over}"
    sigma = f"sqrt(count({c}) OVER {over} * var_pop({c}) OVER {over} / count(*) OVER {over})"
    return f"CASE WHEN stddev_samp({c}) OVER {over} > 0 THEN abs((coalesce({c}, {mean}) - {mean}) / {sigma}) ELSE 0 END"


@query(
    "zscore_global",
    f"""WITH {FEATURED}, z AS (SELECT rec_id, {", ".join(f'{_z(c, "w")} AS "{c}"' for c in _SCORED)} FROM featured WINDOW w AS ())
SELECT rec_id, {", ".join(r(_q(c), f"{c}_ZScore") + f', CAST("{c}" > 3 AS INTEGER) AS "{c}_HighZScore"' for c in _SCORED)} FROM z""",
)
def zscore_global(spark, sf_dir):
    rows = series.zscore_global(featured(spark, sf_dir), _SCORED)
    return rounded(rows.select("rec_id", *[f"{c}_{k}" for c in _SCORED for k in ("ZScore", "HighZScore")]))


@query(
    "zscore_local",
    f"""WITH {FEATURED} SELECT rec_id, {", ".join(r(_z(c, "w"), f"{c}_ZScore_Local") for c in _SCORED)}
FROM featured WINDOW w AS (PARTITION BY "Vehicle_ID")""",
)
def zscore_local(spark, sf_dir):
    rows = series.zscore_local(featured(spark, sf_dir), _SCORED)
    return rounded(rows.select("rec_id", *[f"{c}_ZScore_Local" for c in _SCORED]))


@query(
    "entropy",
    f"""WITH {TELEMETRY}, w AS (SELECT rec_id, list(total_fuel) OVER (PARTITION BY "Vehicle_ID" ORDER BY "timestamp", rec_id
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS xs FROM telemetry),
s AS (SELECT rec_id, xs, len(xs) AS n, list_min(xs) AS lo, list_max(xs) - list_min(xs) AS spread,
  list_aggregate(xs, 'quantile_cont', 0.75) - list_aggregate(xs, 'quantile_cont', 0.25) AS iqr FROM w WHERE len(xs) >= 10),
b AS (SELECT *, CASE WHEN spread > 0 THEN CAST(ceil(spread / least(greatest(2 * iqr / cbrt(n), spread / sqrt(n) / 2), spread / (log2(n) + 1))) AS BIGINT)
  ELSE 1 END AS bins FROM s),
x AS (SELECT rec_id, n, lo, spread, bins, unnest(xs) AS x FROM b),
p AS (SELECT rec_id, n, len(list_filter(range(1, bins), lambda i: x >= lo + i * (spread / bins))) AS place, count(*) AS c FROM x GROUP BY ALL),
h AS (SELECT rec_id, -sum(c / n * log2(c / n)) AS bits FROM p GROUP BY rec_id)
SELECT rec_id, {r("bits", "total_fuel_Entropy")} FROM telemetry LEFT JOIN h USING (rec_id)""",
)
def entropy(spark, sf_dir):
    rows = rolling_entropy(ordered(spark, sf_dir), TRACK, "total_fuel")
    return rounded(rows.select("rec_id", "total_fuel_Entropy"))
