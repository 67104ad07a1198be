"""Batch analytics for asset, sensor and logistics time series on Spark.

Every operator is a function from DataFrame to DataFrame with column names as
parameters; ``derrick.plans`` composes them into features, marts, models and
BI views.
"""
