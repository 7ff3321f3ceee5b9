"""Operators for preparing language-model training data, each over Spark tables."""
