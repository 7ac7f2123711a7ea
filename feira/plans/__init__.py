"""Pipelines made of several operators."""
