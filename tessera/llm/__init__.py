"""Operators for preparing training text at corpus scale.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
