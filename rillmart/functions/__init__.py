"""Scalar helpers: column in, column out."""
