"""Column, window, quantile and indexing helpers shared by the operators."""
