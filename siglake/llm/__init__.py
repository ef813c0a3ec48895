"""Operators for preparing language-model training data.

Ten operators (one module each) plus the helpers they share. Nothing else in
the package imports this subpackage. ``queries`` registers one query per
operator.
"""
