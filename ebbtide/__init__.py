"""Ebbtide: time-aware churn and retention analytics on Spark DataFrames."""
