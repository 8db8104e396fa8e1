"""Sensor-readings analytics as Spark DataFrame plans: clean, merge, model, check and query."""
