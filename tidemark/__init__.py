"""Keyed daily measurement series on Spark: DataFrame in, DataFrame out."""
