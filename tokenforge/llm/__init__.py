"""Operators for building language-model corpora.  Nothing else in the library imports this package."""
