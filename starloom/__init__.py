"""starloom: conform raw public-record extracts into a Parquet star schema on Spark."""

__version__ = "0.1.0"
