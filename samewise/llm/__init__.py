"""Operators that prepare text corpora for training; nothing else in the library imports them."""
