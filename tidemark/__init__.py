"""tidemark — a Spark-native data engine for two-stage recommender pipelines.

Every operator is a DataFrame -> DataFrame function; the catalogue of runnable
queries (with their DuckDB oracle SQL) lives in ``tidemark.plans``.
"""

__version__ = "0.1.0"
