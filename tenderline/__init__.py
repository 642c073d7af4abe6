"""Procurement analytics jobs built on PySpark DataFrames and Spark SQL."""
