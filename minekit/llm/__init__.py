"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which counts as
part of it) imports it.  ``registry`` lists the queries and their SQL.
"""
