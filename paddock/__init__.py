"""Motorsport results analytics on PySpark DataFrames."""
