"""Quarterly feature tables, profiles and data-quality reports from plant telemetry, on Spark."""
