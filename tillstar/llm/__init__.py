"""Operators for training-data pipelines; queries.py and sql.py register them."""
