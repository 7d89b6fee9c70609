"""Operators for building training corpora from raw text at scale.

Nothing else in the library imports this subpackage; its queries are in
``queries`` and the staged job over ``documents`` is ``corpus_pipeline.py`` at
the repository's top.
"""
