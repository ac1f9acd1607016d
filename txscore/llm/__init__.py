"""Operators for preparing large text corpora (training-data pipelines).

Nothing outside this package imports it. ``catalog`` holds the registered
queries; each other module holds one operator with its own general interface.
"""
