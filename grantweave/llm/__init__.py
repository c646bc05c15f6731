"""Operators that prepare text collections for training, and their queries."""
