"""Operators for training-data pipelines: one module per operator.

``queries`` registers one query per operator; nothing else in the library imports
this package.
"""
