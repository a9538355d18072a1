"""Workforce analytics on Spark: timesheet intake, curation, checks and KPIs."""

from shiftledger.rules import Rules

__all__ = ["Rules"]
