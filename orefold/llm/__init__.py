"""Operators of a training-data pipeline: quality, copies, leaks, mixing, output."""
