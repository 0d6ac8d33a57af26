"""Preparation of training text: the operators p1 to p10 and their queries.

Nothing outside this subpackage imports it.
"""
