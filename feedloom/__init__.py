"""feedloom: scheduled, stateful processing of semi-structured feeds on Spark DataFrames."""

__version__ = "0.1.0"
