"""Whole questions and loads composed from the operators."""
