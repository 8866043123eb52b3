"""Typed claims lake and claims-research tables on Spark DataFrames."""
