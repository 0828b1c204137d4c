"""Marts and models built from the operators."""
