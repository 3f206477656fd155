"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator with its own general interface;
``queries`` registers the thin ``opN_*`` queries and the corpus pipeline.
"""
