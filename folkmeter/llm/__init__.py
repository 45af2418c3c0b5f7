"""Operators of training-data pipelines over tables of documents."""
