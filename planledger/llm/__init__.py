"""Operators for building training data from text, vectors, pages and conversations.

Nothing else in the library imports this subpackage.
"""
