"""Whole dataflows wired from sources, operators and sinks."""
