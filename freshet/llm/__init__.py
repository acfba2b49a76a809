"""Operators of a training-data pipeline: search, dedup, cleaning, classifiers, mixing.

Nothing else in the library imports this package; ``registry`` lists its queries.
"""
