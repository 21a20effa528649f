"""Quality rules: every threshold the operators read.

Operators take a :class:`QualityRules` and turn its fields into literals, so
Catalyst folds them into the generated code. Nothing here touches Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# These must equal the monitored system's rules for results to agree.
# Ranges are inclusive at both ends; percentages are 0..100.
TEMPERATURE_RANGE = (-20.0, 40.0)
HUMIDITY_RANGE = (0.0, 100.0)
WIND_SPEED_RANGE = (0.0, 50.0)
MAX_MISSING_PERCENT = 20.0
TIME_WINDOW_MINUTES = 5
VALIDITY_THRESHOLD = 95.0
TIMELINESS_THRESHOLD = 90.0
CONSISTENCY_THRESHOLD = 80.0
JUMP_LIMIT = 10.0
EXPECTED_INTERVAL_SECONDS = 5.0
# Consistency with fewer than two points reports a five-minute wall-clock span
# that does not follow TIME_WINDOW_MINUTES.
SHORT_WINDOW_SPAN_MINUTES = 5

# Metric names in evaluation order (completeness, three validities,
# timeliness, consistency).
METRIC_NAMES = (
    "completeness",
    "temperature_validity",
    "humidity_validity",
    "wind_speed_validity",
    "timeliness",
    "consistency",
)
READING_FIELDS = ("temperature", "humidity", "wind_speed")
# ---------------------------------------------------------------------------

MICROS_PER_SECOND = 1_000_000


@dataclass(frozen=True)
class QualityRules:
    temperature_range: tuple[float, float] = TEMPERATURE_RANGE
    humidity_range: tuple[float, float] = HUMIDITY_RANGE
    wind_speed_range: tuple[float, float] = WIND_SPEED_RANGE
    max_missing_percent: float = MAX_MISSING_PERCENT
    time_window_minutes: int = TIME_WINDOW_MINUTES
    validity_threshold: float = VALIDITY_THRESHOLD
    timeliness_threshold: float = TIMELINESS_THRESHOLD
    consistency_threshold: float = CONSISTENCY_THRESHOLD
    jump_limit: float = JUMP_LIMIT
    expected_interval_seconds: float = EXPECTED_INTERVAL_SECONDS

    @property
    def window_us(self) -> int:
        """Window length in microseconds; a point stays while ts > t - window."""
        return int(self.time_window_minutes * 60 * MICROS_PER_SECOND)

    @property
    def expected_points(self) -> float:
        """Readings expected in a full window (300 s / 5 s = 60 by default)."""
        return (self.time_window_minutes * 60) / self.expected_interval_seconds

    def range_of(self, field: str) -> tuple[float, float]:
        return {
            "temperature": self.temperature_range,
            "humidity": self.humidity_range,
            "wind_speed": self.wind_speed_range,
        }[field]


DEFAULT_RULES = QualityRules()
