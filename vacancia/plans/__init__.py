"""Operators composed: the masters, the star, the registered queries."""
