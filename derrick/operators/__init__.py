"""Parameterised operators: DataFrame in, DataFrame out."""
