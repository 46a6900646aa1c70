"""Operators for building training corpora, one module per operator.

Nothing else in the library imports this package; ``queries.py`` registers
one query per operator and ``corpus_pipeline.py`` chains five of them.
"""
