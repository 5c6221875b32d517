"""Structured Streaming entry: a file-arrival trigger for the month job."""

from fareline.streaming.landing import landed_months, start

__all__ = ["landed_months", "start"]
