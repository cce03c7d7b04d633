"""Mapping and reconciling monthly revenue with Spark."""
