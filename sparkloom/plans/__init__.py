"""Compositions of operators and the catalogue of registered queries."""
