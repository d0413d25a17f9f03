"""Operators for preparing training data, each over a whole table and usable on its own."""
