"""Interval-meter analytics as lazy DataFrame operators on Spark SQL."""

from wattloom.settings import MeterSettings

__all__ = ["MeterSettings"]
