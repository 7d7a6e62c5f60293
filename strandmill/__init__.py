"""Strandmill: sequence overlap, consensus and assembly-graph analytics on Spark DataFrames."""

__version__ = "0.1.0"
