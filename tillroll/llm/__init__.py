"""Operators and queries for preparing language-model training data.

Nothing outside this subpackage imports it; ``queries.py`` lists what
``__spark_entry__`` registers, and ``corpus_pipeline`` (repository top)
chains five of the operators over ``documents``.
"""
