"""Operators for building training data: one module an operator, queries beside them."""
