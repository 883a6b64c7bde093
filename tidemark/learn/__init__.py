"""Feature tables, Spark ML models, evaluation and model registry."""
