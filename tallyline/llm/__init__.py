"""Operators of a training-data pipeline (see the catalog module)."""
