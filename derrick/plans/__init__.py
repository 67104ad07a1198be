"""Compositions of operators: features, marts, models and BI views."""
