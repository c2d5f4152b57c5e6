"""Operators for preparing text corpora for training. Nothing else in the package imports this folder."""
