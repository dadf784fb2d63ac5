"""Batch jobs for energy-meter time series on Spark."""
