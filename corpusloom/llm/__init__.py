"""Operators that turn a document table into training data. Nothing outside this subpackage imports it."""
