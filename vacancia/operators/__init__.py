"""Operators: a DataFrame (or a few) in, a lazy DataFrame out."""
