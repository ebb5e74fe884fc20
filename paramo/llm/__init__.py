"""Operators of a training-data pipeline over text corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; :mod:`paramo.llm.queries` registers the
queries that apply the operators to the test tables.
"""
