"""Retrieval models as batch operators."""
