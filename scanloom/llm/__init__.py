"""Operators for training-data collections; nothing outside this subpackage imports it."""
