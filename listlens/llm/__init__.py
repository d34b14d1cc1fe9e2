"""Operators for building a training corpus; nothing outside this folder imports them."""
