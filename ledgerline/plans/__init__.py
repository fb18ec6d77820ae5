"""Whole jobs: the daily run, the query catalogue, and the tables it derives."""
