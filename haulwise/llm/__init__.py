"""Operators for preparing language-model training text.

Each operator is a function over DataFrames; ``queries.py`` registers the thin
``opN_...`` queries over the standard tables. Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
