"""Operators for preparing training data; nothing else in the library depends on them."""
