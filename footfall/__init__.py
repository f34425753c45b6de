"""Footfall: user-behaviour warehouse jobs on Spark DataFrames and Structured Streaming."""
