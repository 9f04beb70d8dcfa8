"""Operators for training-data pipelines over the corpus tables. Nothing outside this subpackage imports it."""
