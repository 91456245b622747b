"""Operators of a training-data pipeline (documents, conversations) on Spark.

Nothing else in the library imports this subpackage.
"""
