"""Operators of a training-data pipeline, written as Spark jobs.

Nothing else in the library imports this package; ``registry`` holds its
queries, which the driver entry adds when the package is present.
"""
