"""Operators for preparing training text, each built by one named method; nothing else in the library imports them."""
