"""Operators: one module per family, DataFrame in, DataFrame out."""
