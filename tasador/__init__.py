"""Listing-price analytics on Spark: DataFrame operators for cleaning, geo features, radius joins, segments, ensembles, metrics and request scoring."""
