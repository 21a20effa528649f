"""Sensor data quality on Spark: trailing-window metrics, alerts and reports.

Every operator is ``DataFrame -> DataFrame`` and lazy; the caller owns the
session. See README.md for the operator map.
"""

from sensorqc.rules import DEFAULT_RULES, QualityRules

__all__ = ["DEFAULT_RULES", "QualityRules"]
