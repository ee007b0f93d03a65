"""Training-data operators: filtering, de-duplication, decontamination,
tokenisation and archives over large text tables. Nothing outside this
subpackage imports it except the guarded hook in ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
