"""Operators for preparing training text, each written for Spark at scale.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
