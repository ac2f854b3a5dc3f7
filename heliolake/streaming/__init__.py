"""Structured Streaming refresh of the lakehouse (ST1)."""

from heliolake.streaming.bronze_stream import refresh_days, start_bronze_refresh
from heliolake.streaming.change_stream import refresh_units, start_change_refresh

__all__ = ["refresh_days", "refresh_units", "start_bronze_refresh", "start_change_refresh"]
