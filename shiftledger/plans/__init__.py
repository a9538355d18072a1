"""Logical plans: cleaning, curation, checks, KPIs, lookups, reports and the full refresh."""
