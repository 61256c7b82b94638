"""Operators for building training corpora, each in a module of its own."""
