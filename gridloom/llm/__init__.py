"""Operators for preparing large text corpora as training data.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator; each operator module keeps its own general interface.
"""
