"""Whole questions, written with the operators and plain DataFrame calls."""
