"""Sensor-lake to star-schema analytics on Spark DataFrames."""
