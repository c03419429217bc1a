"""Layered warehouse, data-quality and lineage jobs expressed as Spark DataFrames."""
