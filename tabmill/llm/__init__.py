"""Operators for building training data from text, embeddings and conversations."""
