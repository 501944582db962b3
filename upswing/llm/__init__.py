"""Operators that prepare text for training: each module has one operator."""
