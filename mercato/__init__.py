"""Marketplace analytics on Spark DataFrames: lake layers, quality, metrics, change feeds, streams, graphs and models."""
