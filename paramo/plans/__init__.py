"""Whole plans built from the operators, and lineage-cut helpers."""
