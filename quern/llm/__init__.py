"""Operators of a training-data pipeline over documents, one module each."""
