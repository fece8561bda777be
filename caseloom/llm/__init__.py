"""Operators for preparing text corpora. Nothing outside this folder and ``corpus_pipeline.py`` imports it."""
