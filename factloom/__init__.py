"""Telemetry-fact analytics on PySpark: declarative operators, plans, streams."""
