"""Operators of a training-data pipeline over ``documents``; ``queries`` registers them."""
