"""Operators that prepare text and vectors for training; nothing outside imports them."""
