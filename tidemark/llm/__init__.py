"""Training-data operators: quality, language-model scoring, deduplication,
mixing, vector search, token counts, privacy, secrets and decontamination.

Nothing else in the library imports this subpackage.
"""
