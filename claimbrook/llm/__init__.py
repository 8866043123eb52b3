"""Operators for training-data pipelines, each with one query over its whole table."""
