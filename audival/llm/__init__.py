"""Operators for large training-text pipelines. Nothing outside this folder,
``corpus_pipeline.py`` and ``tests/llm`` uses them."""
