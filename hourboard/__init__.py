"""Hourly signage impressions from raw HTTP request logs, on Spark DataFrames."""

from hourboard.jobs import ImpressionJob
from hourboard.plans.impressions import hourly_impressions

__all__ = ["ImpressionJob", "hourly_impressions"]
