"""Operators of training-data pipelines over documents, embeddings and conversations."""
