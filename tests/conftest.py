import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from odoscan.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def fleet(spark):
    """Three vehicles, one holding most rows, with nulls, ties in time and standing runs."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n = 1500
    vehicle = np.where(rng.random(n) < 0.8, "V1", np.where(rng.random(n) < 0.5, "V2", "V3"))
    rows = pd.DataFrame(
        {
            "rec_id": rng.permutation(n),
            "Vehicle_ID": vehicle,
            "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 40_000, n) * 3, unit="s"),
            "total_fuel": np.round(rng.random(n) * 100, 2),
            "speed_raw": np.where(rng.random(n) < 0.6, 0.0, np.round(rng.random(n) * 100, 1)),
            "driver_name": np.where(rng.random(n) < 0.1, None, np.where(rng.random(n) < 0.5, "D1", "D2")),
            "location": np.where(rng.random(n) < 0.1, None, np.where(rng.random(n) < 0.7, "P1", "P2")),
        }
    )
    schema = (
        "rec_id long, Vehicle_ID string, timestamp timestamp_ntz, total_fuel double, speed_raw double, "
        "driver_name string, location string"
    )
    return spark.createDataFrame(rows.astype({"rec_id": "int64"}), schema).cache()
