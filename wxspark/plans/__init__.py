"""Whole jobs built from the sources and operators."""
