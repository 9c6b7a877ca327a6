"""Operators for training-data work. Nothing else in beadloom imports this package."""
