"""Operators of a training-data pipeline, one module each; nothing else in the library uses them."""
