"""Relational, key, dimension, fact, mutation, quality and sampling operators."""
