"""Operators for large text corpora and the pipeline stages built on them."""
