"""Operators for training-data pipelines, one module per operator."""
