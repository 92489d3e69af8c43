"""Operators for preparing training data.  Nothing else in the library
imports this subpackage; it may import general helpers from it."""
