"""Operators on training documents, one module each; ``queries`` registers them."""
