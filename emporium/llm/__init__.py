"""Operators of a training-data pipeline, each one a set of Spark jobs.

Nothing else in the library imports this subpackage.
"""
