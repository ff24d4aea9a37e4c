"""Training-data operators: near duplicates, packing, archives, media, search, quality.

Nothing outside this folder imports it.  ``tessera.llm.registry`` holds the queries.
"""
