"""Transformations: DataFrame in, DataFrame out, no reading or writing."""
