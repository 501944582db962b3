"""Trend velocity analytics on Spark DataFrames."""

from upswing.partners import APPLE, SPOTIFY, Partner

__all__ = ["APPLE", "SPOTIFY", "Partner"]
