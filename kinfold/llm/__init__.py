"""Operators for preparing large text corpora for training."""
