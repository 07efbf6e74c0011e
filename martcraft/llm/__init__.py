"""Training-data operators: mixing, search, deduplication, tokens, alignment, extraction and filtering.

Each module holds one operator with its own general interface; ``queries``
derives the registered ``opN_*`` queries from them. Nothing outside this
subpackage imports it, apart from the guarded import in ``__spark_entry__.py``
and ``corpus_pipeline.py``.
"""
