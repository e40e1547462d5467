"""Trend analytics of ranked lists and feeds on Spark: an append-only observation log, and views derived from it."""
