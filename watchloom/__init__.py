"""Donated watch-history analytics on Spark: functions, operators, sources, plans, streaming."""
