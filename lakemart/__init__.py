"""lakemart: lake ingestion, star-schema modelling and analytics as lazy Spark
DataFrame operators (see README.md for the operator map)."""

__version__ = "0.1.0"
