"""Operators for preparing training data; the rest of the library imports nothing from here."""
