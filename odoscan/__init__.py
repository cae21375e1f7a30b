"""Keyed time-series features, scoring and anomaly ranking on Spark DataFrames."""

from odoscan.config import Roles, Settings, Track

__all__ = ["Roles", "Settings", "Track"]
