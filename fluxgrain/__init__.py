"""fluxgrain: device telemetry analytics on Spark DataFrames."""
