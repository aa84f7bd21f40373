"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package imports it, except the guarded block in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
