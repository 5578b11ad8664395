"""Whole jobs built from the operators: pipeline, store, search."""
