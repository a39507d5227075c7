"""Operators that prepare records and texts for model training."""
