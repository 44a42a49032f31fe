"""Operators of a pipeline for training data. Nothing else in this package imports this one."""
