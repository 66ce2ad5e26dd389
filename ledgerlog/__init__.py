"""Operational log analytics and business reporting as Spark jobs.

Every public function maps DataFrames (or Columns) to DataFrames (or Columns),
never reads the clock, and leaves physical planning to Catalyst and AQE.
"""
