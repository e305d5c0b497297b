"""Operators for training-data pipelines over documents, pages and conversations.

Nothing else in the package imports from here.
"""
