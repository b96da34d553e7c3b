"""Operators on whole tables. Each one is a DataFrame in, a DataFrame out."""
