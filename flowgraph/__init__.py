"""Forecasting on road-like networks, written as Spark DataFrame jobs."""
