"""Operators: plain ``DataFrame -> DataFrame`` functions, grouped by stage."""
