"""Operators that prepare text and vectors for training language models. Nothing else in the package imports this one."""
