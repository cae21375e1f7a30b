"""Column roles, thresholds and size limits shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Track:
    """How rows form ordered series: one series per ``entity``, sorted by ``order``.

    ``order`` must be unique within an entity, so it normally ends in the record
    id. A series longer than ``block_rows`` is cut into blocks of exactly that
    many rows (see ``operators.ordering``).
    """

    entity: str = "Vehicle_ID"
    order: tuple[str, ...] = ("timestamp", "rec_id")
    block_rows: int = 2_000_000


@dataclass(frozen=True)
class Roles:
    """Which column plays which part. Absent optional columns skip their features."""

    entity: str = "Vehicle_ID"
    time: str = "timestamp"
    record: str = "rec_id"
    level: str = "total_fuel"
    speed: str = "speed_raw"
    actor: str = "driver_name"
    place: str = "location"
    ignition: str = "ignition_raw"
    coordinates: str = "coordinates"
    source: str = "Source_File"
    label: str = "Stationary_drain"

    def track(self, settings: Settings) -> Track:
        return Track(self.entity, (self.time, self.record), settings.block_rows)


# Raw header -> canonical column name.
HEADER_ALIASES = {
    "Tanque total": "total_fuel",
    "Tanque Total": "total_fuel",
    "Calidad de señal": "quality_signal",
    "Tanque Izquierdo": "left_tank",
    "Batería interna": "internal_battery",
    "Batería vehículo": "vehicle_battery",
    "Tanque Derecho": "right_tank",
    "Ubicación": "location",
    "Coordenadas": "coordinates",
    "Tiempo": "timestamp",
    "Velocidad": "speed_raw",
    "Altitud": "altitude",
    "Driver": "driver_name",
    "Ignición": "ignition_raw",
}

# Weight of each rule in the rule score.
RULE_WEIGHTS = {
    "stationary_loss": 3.0,
    "night_loss": 2.0,
    "rapid_loss": 3.0,
    "high_deviation": 2.0,
    "sudden_drop": 3.0,
    "unusual_location": 1.0,
}


@dataclass(frozen=True)
class Settings:
    # Defaults of the cleaning and feature steps.
    missing_markers: tuple[str, ...] = ("-----",)
    numeric_columns: tuple[str, ...] = ("Network Jamming", "GNSS Jamming", "total_fuel", "speed_raw")
    speed_bounds: tuple[float, float] = (0.0, 200.0)
    level_bounds: tuple[float, float] = (0.0, 400.0)
    night_hours: tuple[int, int] = (22, 5)
    refuel_threshold: float = 15.0
    stationary_loss_threshold: float = 2.5
    night_loss_threshold: float = 3.0
    rapid_loss_rate: float = -0.5
    sudden_drop_level: float = -5.0
    sudden_drop_minutes: float = 30.0
    rolling_windows: tuple[int, ...] = (5, 10, 30)
    lags: tuple[int, ...] = (1, 2, 3)
    rule_weights: dict[str, float] = field(default_factory=lambda: dict(RULE_WEIGHTS))
    place_rule: str = "lt"  # 'lt' flags the commonest places, 'gt' the rarest

    # Defaults of the model steps.
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5
    resampling: str = "smote"
    neighbours: int = 5
    max_clusters: int = 10
    restarts: int = 10
    cluster_rounds: int = 300
    eps: float = 0.5
    min_samples: int = 5
    contamination: float = 0.01
    trees: int = 100
    forest_depth: int = 30  # Spark's deepest tree
    boosting_rounds: int = 100
    learning_rate: float = 0.1
    network_rounds: int = 500

    # Size limits. Beyond them an operator takes its split or shuffled path.
    block_rows: int = 2_000_000
    broadcast_rows: int = 100_000
    exact_group_rows: int = 4_000_000
    fit_bytes: int = 256 << 20  # a training matrix that one task may hold
    fits_at_once: int = 4  # independent model fits submitted side by side

    # False: build the features the original column names left dead.
    compat: bool = False
