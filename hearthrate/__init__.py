"""Listing-price analytics as PySpark DataFrame operators."""
