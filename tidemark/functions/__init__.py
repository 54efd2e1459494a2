"""Scalar helpers as column expressions."""
