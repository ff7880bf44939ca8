"""Operators for training-data corpora; ``queries`` lists them by their query names."""
