"""Operators for preparing text and vectors for training, one module each; ``queries`` registers them."""
