"""Layered (bronze, silver, gold) table building on the public DataFrame API."""
