"""Demand-series analytics for daily store x item data, expressed as Spark DataFrame jobs."""
