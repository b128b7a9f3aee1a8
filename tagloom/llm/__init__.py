"""Operators over text, page and vector corpora for training data; nothing else in the library imports this package."""
