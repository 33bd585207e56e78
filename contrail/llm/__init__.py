"""Operators of a training-data pipeline on Spark DataFrames. Nothing else
in the library imports this subpackage."""
