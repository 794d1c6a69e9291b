"""Operators of a training-data pipeline over documents and vectors (nothing else in the library imports this)."""
