"""Operators of a training-data pipeline over document corpora.

One module per operator, each usable on its own frames; ``queries`` binds them
to the test tables.  Nothing outside this package imports it, apart from the
guarded import in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
