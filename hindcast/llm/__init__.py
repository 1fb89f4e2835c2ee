"""Operators for preparing training data. Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports them."""
