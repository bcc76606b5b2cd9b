"""Streaming analytics dataflows on Spark DataFrames and Structured Streaming."""
