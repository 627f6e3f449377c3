"""Operators of a training-data pipeline, each a DataFrame -> DataFrame job.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries (``llm.registry``) and ``corpus_pipeline.py`` when they are present.
"""
