"""Training-data operators: deduplication, tokenising, filtering, formatting.

Nothing outside this folder imports it; see ``queries.py`` for the registered
queries and ``corpus_pipeline.py`` at the repository top for the pipeline.
"""
