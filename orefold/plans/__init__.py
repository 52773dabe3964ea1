"""Whole layered builds and the panel queries over their gold tables."""
