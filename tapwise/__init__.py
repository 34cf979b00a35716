"""Fare-card trip analytics on Spark: taps in, one wide trip table out."""
