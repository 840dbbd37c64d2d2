"""Operators of a training-data pipeline, each usable on its own.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.  The operators take
and return DataFrames; :mod:`slicewright.llm.queries` binds them to the given tables.
"""
