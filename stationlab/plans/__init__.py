"""Compositions of operators: layer builds and gold feature sets."""
