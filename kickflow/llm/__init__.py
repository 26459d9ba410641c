"""Operators that prepare a training corpus; nothing else of the library imports them."""
