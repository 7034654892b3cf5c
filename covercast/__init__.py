"""Booking-demand analytics for hospitality shifts, built on PySpark DataFrames."""

from covercast.sources.load import load_sources, require_columns

__all__ = ["load_sources", "require_columns"]
