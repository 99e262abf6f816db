"""Operators for training-data pipelines: documents in, decisions and layouts out."""
