"""Telemetry alignment, quality, features and short-horizon forecasting on Spark.

Every public function takes and returns Spark DataFrames; nothing here holds
readings on the driver.  See README.md for the map of the package.
"""
