"""Operators for preparing text corpora, one module each, and their registered queries."""
