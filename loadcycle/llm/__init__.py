"""Operators for preparing training text: tokenisers, duplicates, search, mixing, chat layouts and models."""
