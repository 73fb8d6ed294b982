"""Operators for training data from large text collections."""
