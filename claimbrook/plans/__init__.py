"""Whole jobs: converting deliveries, and the queries built from the operators."""
