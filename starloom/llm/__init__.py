"""Operators for preparing language-model training text, each by one named method.

Every module holds one operator; ``catalog`` registers their queries.  Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
