"""Sensor-fleet analytics as Spark DataFrame operators, batch layers and streams."""
