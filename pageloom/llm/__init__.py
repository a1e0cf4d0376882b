"""Operators for training data: near and exact repeats, languages, tokens, fixity, URL lists.

Nothing else in the library imports this package.
"""
