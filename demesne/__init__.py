"""Demesne: analytics over leasehold registers on Spark DataFrames."""
