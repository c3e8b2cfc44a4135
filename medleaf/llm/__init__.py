"""Operators for building training data from document and page tables."""
