"""roadlens: traffic-device analytics as Spark DataFrame, SQL, ML and streaming jobs."""

__version__ = "0.1.0"
